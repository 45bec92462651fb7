"""Queries of problem 7 and their SQL."""

from __future__ import annotations

from tidewrack.operators.balance import cluster_sizes, records_with_sizes
from tidewrack.session import table


def p7_found(spark, sf):
    return cluster_sizes(table(spark, sf, "clusters")).where("is_stale").select("text_cluster_id")


def p7_sizes(spark, sf):
    return cluster_sizes(table(spark, sf, "clusters"))


def p7_records(spark, sf):
    return records_with_sizes(table(spark, sf, "clusters"))


_COUNTS = """select text_cluster_id, count(distinct (dataset, cut_id)) as members, min(cluster_size) as min_recorded,
 max(cluster_size) as max_recorded from clusters where text_cluster_id is not null group by 1"""

QUERIES = {"p7_found": p7_found, "p7_sizes": p7_sizes, "p7_records": p7_records}
SQL = {
    "p7_found": f"select text_cluster_id from ({_COUNTS}) where min_recorded <> members or max_recorded <> members",
    "p7_sizes": f"select *, coalesce(min_recorded <> members or max_recorded <> members, false) as is_stale from ({_COUNTS})",
    "p7_records": f"select c.text_cluster_id, c.dataset, c.cut_id, c.cluster_size, n.members from clusters c join ({_COUNTS}) n using (text_cluster_id)",
}
