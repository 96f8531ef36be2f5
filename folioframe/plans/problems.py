"""Registered queries of the general training-data problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import coverage
from ..operators.reconcile import differences, digest
from ..sources.tables import table

#: Well below the pages of one kanda (3 to 276 in sf0.1), so that its runs are clipped and stitched.
PAGES_A_SHARD = 64


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous runs of covered pages and the gaps between them, per scan and kanda."""
    found = coverage(table(spark, sf_dir, "sarga_span"), ["scan_id", "kanda"], "start_page", "end_page", fallback="heading_page", width=PAGES_A_SHARD)
    return found.withColumns({c: F.col(c).cast("int") for c in ("first_page", "last_page")})


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows one manifest copy lacks and the fields in which the copies differ."""
    fields = {"sha256": digest(F.col("sha256")), "size_bytes": F.col("size_bytes"), "source_sha256": digest(F.col("source_sha256"))}
    return differences(table(spark, sf_dir, "manifest_origin"), table(spark, sf_dir, "manifest_synced"), ["scan_id", "tree", "page"], fields)


QUERIES = {"p2_found": p2_found, "p3_found": p3_found}

_DIGEST = "regexp_replace(regexp_replace(lower(trim({0})), '^(sha-?256\\s*[:=]|0x)', ''), '[^0-9a-z]', '', 'g')"
_SIDE = (
    "select scan_id, tree, page, count(*) n, list_sort(list(distinct coalesce('=' || " + _DIGEST.format("sha256") + ", 'null'))) sha256, "
    "list_sort(list(distinct coalesce('=' || size_bytes, 'null'))) size_bytes, "
    "list_sort(list(distinct coalesce('=' || " + _DIGEST.format("source_sha256") + ", 'null'))) source_sha256 from {0} group by all"
)

ORACLES = {
    "p2_found": """
with spans as (
  select scan_id, kanda, coalesce(start_page, heading_page) s, end_page e from sarga_span
  where coalesce(start_page, heading_page) <= end_page),
marked as (
  select *, case when s > 1 + max(e) over (partition by scan_id, kanda order by s, e rows between unbounded preceding and 1 preceding)
    then 1 else 0 end fresh from spans),
numbered as (select *, sum(fresh) over (partition by scan_id, kanda order by s, e rows unbounded preceding) run from marked),
periods as (select scan_id, kanda, min(s) s, max(e) e from numbered group by scan_id, kanda, run),
following as (select *, lead(s) over (partition by scan_id, kanda order by s) next_s from periods)
select scan_id, kanda, 'period' kind, s::int first_page, e::int last_page from periods
union all
select scan_id, kanda, 'gap', (e + 1)::int, (next_s - 1)::int from following where next_s is not null""",
    "p3_found": f"""
with a as ({_SIDE.format('manifest_origin')}), b as ({_SIDE.format('manifest_synced')}),
pairs as (
  select coalesce(a.scan_id, b.scan_id) scan_id, coalesce(a.tree, b.tree) tree, coalesce(a.page, b.page) page, a.n an, b.n bn,
    a.sha256 as1, b.sha256 bs1, a.size_bytes as2, b.size_bytes bs2, a.source_sha256 as3, b.source_sha256 bs3
  from a full join b on a.scan_id is not distinct from b.scan_id and a.tree is not distinct from b.tree and a.page is not distinct from b.page)
select scan_id, tree, page, 'only_origin' difference from pairs where bn is null
union all select scan_id, tree, page, 'only_synced' from pairs where an is null
union all select scan_id, tree, page, 'sha256' from pairs where an is not null and bn is not null and as1 <> bs1
union all select scan_id, tree, page, 'size_bytes' from pairs where an is not null and bn is not null and as2 <> bs2
union all select scan_id, tree, page, 'source_sha256' from pairs where an is not null and bn is not null and as3 <> bs3""",
}
