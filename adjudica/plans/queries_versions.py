"""Queries over versions of a table, and over names with a large table of aliases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.operators import aliases as A
from adjudica.operators import drift as V
from adjudica.plans import domain as D
from adjudica.plans.registry import query

_VERSIONS = """
old as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders where o_orderkey * 7 % 499 <> 1),
new as (select o_orderkey, o_custkey, case when o_orderkey * 7 % 499 = 2 then o_totalprice + 1 else o_totalprice end as o_totalprice,
    case when o_orderkey * 7 % 499 in (2, 3) then null else o_orderpriority end as o_orderpriority from orders where o_orderkey * 7 % 499 <> 4)"""


@query("drift", f"""
    with {_VERSIONS}
    select o_orderkey, case when o.o_custkey is null then 'added' when n.o_custkey is null then 'removed' else 'changed' end as change,
      case when o.o_custkey is null or n.o_custkey is null then '' else concat_ws(',', case when o.o_orderpriority is distinct from n.o_orderpriority then 'o_orderpriority' end,
        case when o.o_totalprice is distinct from n.o_totalprice then 'o_totalprice' end) end as columns
    from old o full join new n using (o_orderkey)
    where o.o_custkey is null or n.o_custkey is null or o.o_orderpriority is distinct from n.o_orderpriority or o.o_totalprice is distinct from n.o_totalprice
""")
def drift(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of the orders; a few rows were added, removed or changed."""
    rows = D.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").withColumn("t", F.expr("o_orderkey * 7 % 499"))
    old = rows.where("t <> 1").drop("t")
    new = rows.where("t <> 4").withColumns(
        {"o_totalprice": F.expr("case when t = 2 then o_totalprice + 1 else o_totalprice end"), "o_orderpriority": F.expr("case when t not in (2, 3) then o_orderpriority end")}
    ).drop("t")
    found = V.drift(old, new, ["o_orderkey"])
    return found.select("o_orderkey", "change", F.array_join("columns", ",").alias("columns"))


@query("longest_aliases", """
    with known as (select lower(p_name) as alias, min('part ' || p_partkey) as canonical from part group by 1
      union all select lower(c_name), min('customer ' || c_custkey) from customer group by 1),
    texts as (select distinct case when p_partkey % 3 = 0 then lower(p_name) else 'see ' || lower(p_name) || ', ' || lower(c_name) || '.' end as text
      from part join customer on c_custkey = p_partkey % (select max(c_custkey) from customer) + 1)
    select text, alias, canonical from texts, known where contains(text, alias)
    qualify row_number() over (partition by text order by length(alias) desc, instr(text, alias)) = 1
""")
def longest_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that name parts and customers, against an alias for each of these."""
    part, customer = D.table(spark, sf, "part"), D.table(spark, sf, "customer")
    known = part.select(F.lower("p_name").alias("alias"), F.concat(F.lit("part "), "p_partkey").alias("canonical"))
    known = known.unionByName(customer.select(F.lower("c_name").alias("alias"), F.concat(F.lit("customer "), "c_custkey").alias("canonical")))
    last = customer.agg(F.max("c_custkey").alias("n")).first()["n"]
    met = part.join(customer, F.col("c_custkey") == F.col("p_partkey") % last + 1)
    text = F.when(F.col("p_partkey") % 3 == 0, F.lower("p_name")).otherwise(F.concat(F.lit("see "), F.lower("p_name"), F.lit(", "), F.lower("c_name"), F.lit(".")))
    return A.longest_aliases(met.select(text.alias("text")), known)
