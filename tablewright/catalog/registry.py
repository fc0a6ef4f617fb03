"""Registration of queries: ``f(spark, folder) -> DataFrame`` plus optional SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        name = run.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def bucket_sql(salt: str, buckets: int, *keys: str) -> str:
    """SQL twin of ``functions.hash_bucket``."""
    text = " || '|' || ".join([f"'{salt}'", *[f"coalesce(cast({k} as varchar), '')" for k in keys]])
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint % {buckets})"


# SQL twins of the input tables in plans/standins.py.

DIRTY = """
dirty as (
  select cast(o_orderkey as varchar) as order_id,
         ' ' || case when o_orderkey % 13 = 0 then '|1x3'
                     else cast(cast(round(o_totalprice * 100) as bigint) as varchar) end as cents,
         '  ' || o_orderstatus || ' ' as status,
         ' ' || case when o_orderpriority = '4-NOT SPECIFIED' then '?'
                     else o_orderpriority end as priority,
         ' ' || cast(o_custkey as varchar) as unused,
         ' ' || case when o_orderkey % 97 = 0 then 'unknown'
                     else case when o_totalprice > 250000 then '>50K' else '<=50K' end
                          || case when o_orderkey % 2 = 0 then '.' else '' end end as label
  from orders)
"""

RISK = """
risk as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber,
         l_quantity, l_extendedprice, l_discount, l_tax,
         case when l_extendedprice * (1 - l_discount) > 50000 then 1 else 0 end as target
  from lineitem)
"""

INCOME = """
income as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
         l_returnflag, l_linestatus, p_type, p_brand, p_size, p_retailprice,
         case when l_quantity * p_retailprice
                   * case when l_returnflag = 'R' then 1.5 else 1.0 end::double > 30000
              then 1 else 0 end as label
  from lineitem join part on l_partkey = p_partkey)
"""

LABELED = """
labeled as (
  select d.doc_id, d.text, l.toxic, l.quality
  from documents d left join labels l on d.doc_id = l.doc_id)
"""

LINE_KEY_SQL = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "cast(round(l_quantity * 100) as bigint)",
    "cast(round(l_extendedprice * 100) as bigint)",
]
