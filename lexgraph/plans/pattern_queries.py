"""Graph patterns over the driver's tables, by name, with their SQL: orders stand for decisions, drafts and acts, customers
for the laws they point at, nations for topics, clusters and institutions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import resolve as R
from . import graph_queries as Q
from . import reports
from .queries import QUERIES, SQL, _register, _t

__all__ = ["QUERIES", "SQL"]


def _iri(kind: str, key: str) -> Column:
    return F.concat(F.lit(kind), F.col(key).cast("string"))


def _orders(spark, sf) -> DataFrame:
    c = _t(spark, sf, "customer")
    return _t(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("day", F.to_date("o_orderdate")).withColumn("iri", _iri("o", "o_orderkey"))


def _edges(spark, sf) -> DataFrame:
    """Every order points at its customer, by a predicate of its status."""
    pred = F.when(F.col("o_orderstatus") == "F", "interpretsLaw").when(F.col("o_orderstatus") == "O", "amendsLaw").otherwise("transposesDirective")
    return _orders(spark, sf).select(F.col("iri").alias("src"), pred.alias("pred"), _iri("c", "c_custkey").alias("dst"))


_ORDERS = "(select *, 'o' || o_orderkey iri, o_orderdate::date::varchar as iso_day from orders join customer on o_custkey = c_custkey)"


@_register(f"select iri, iso_day from {_ORDERS} where contains(c_mktsegment, 'MACH') order by o_orderdate::date desc, iri limit 20")
def pattern_decisions_citing(spark, sf):
    d = _orders(spark, sf).select("iri", F.col("day").alias("decision_date"), F.array("c_mktsegment", F.lit("x")).alias("referenced_law"))
    return Q.decisions_citing(d, "MACH").select("iri", F.col("decision_date").cast("string").alias("iso_day"))


@_register(f"select iri, case o_orderstatus when 'O' then 'Open' else 'Finished' end phase_label from {_ORDERS} where lower(c_mktsegment) like '%house%' and o_orderstatus in ('O', 'F')")
def pattern_drafts_amending(spark, sf):
    d = _orders(spark, sf).select("iri", F.col("o_orderstatus").alias("phase"), F.array("c_mktsegment").alias("affected_law_name"))
    return Q.drafts_amending(d, "House", spark.createDataFrame([("O", "Open"), ("F", "Finished")], "phase string, phase_label string")).select("iri", "phase_label")


@_register(f"select iri, iso_day from {_ORDERS} where o_totalprice > 250000 and o_orderpriority = '2-HIGH' order by o_orderdate::date desc, iri limit 20")
def pattern_acts_in_force(spark, sf):
    a = _orders(spark, sf).select("iri", (F.col("o_totalprice") > 250000).alias("in_force"), F.col("o_orderpriority").alias("doc_type"), F.col("day").alias("document_date"))
    return Q.acts_in_force(a, "2-HIGH").select("iri", F.col("document_date").cast("string").alias("iso_day"))


@_register(f"select iri, iso_day from {_ORDERS} where o_orderpriority = '1-URGENT' and o_orderkey % 3 <> 0 order by o_orderdate::date desc, iri limit 20")
def pattern_judgments(spark, sf):
    d = _orders(spark, sf).select("iri", F.col("o_orderpriority").alias("decision_type"), F.when(F.col("o_orderkey") % 3 != 0, F.col("iri")).alias("ecli"), F.col("day").alias("document_date"))
    return Q.judgments(d, "1-URGENT").select("iri", F.col("document_date").cast("string").alias("iso_day"))


@_register(f"select iri src, 'c' || c_custkey dst, o_orderpriority case_number, iso_day from {_ORDERS} where o_orderstatus = 'F'")
def pattern_provision_links(spark, sf):
    d = _orders(spark, sf).select("iri", F.col("o_orderpriority").alias("case_number"), F.col("day").alias("decision_date"))
    return Q.provision_links(_edges(spark, sf), d).select("src", "dst", "case_number", F.col("decision_date").cast("string").alias("iso_day"))


@_register("""
with e as (select 'lex:A' || (p_partkey % 9) || '_Par_' || p_size src, 'lex:B_Par_' || p_partkey dst from part)
select src, dst from e where starts_with(src, 'lex:A3_Par_')""")
def pattern_references_of_law(spark, sf):
    e = _t(spark, sf, "part").select(F.expr("'lex:A' || (p_partkey % 9) || '_Par_' || p_size").alias("src"), F.lit("references").alias("pred"), F.expr("'lex:B_Par_' || p_partkey").alias("dst"))
    return Q.references_of_law(e, "lex:A3").select("src", "dst")


@_register("select p_partkey, p_size from part where p_size % 10 = 3")
def pattern_provisions_of_cluster(spark, sf):
    p = _t(spark, sf, "part").withColumn("requested_cluster", F.concat(F.lit("cluster"), (F.col("p_size") % 10).cast("string")))
    return Q.provisions_of_cluster(p, "cluster3").select("p_partkey", "p_size")


@_register("""
with e as (select o_orderkey a, o_custkey b, o_orderstatus s from orders)
select distinct 'o' || a src, 'c' || b dst from e where s in ('F', 'O')""")
def pattern_mutual_references(spark, sf):
    o = _t(spark, sf, "orders")
    forth = o.select(_iri("o", "o_orderkey").alias("src"), F.lit("references").alias("pred"), _iri("c", "o_custkey").alias("dst"))
    back = o.where("o_orderstatus in ('F', 'O')").select(_iri("c", "o_custkey").alias("src"), F.lit("referencedBy").alias("pred"), _iri("o", "o_orderkey").alias("dst"))
    return Q.mutual_references(forth.unionByName(back))


@_register(f"select 'c' || c_custkey dst, c_mktsegment title, iri src, o_orderpriority as label_text, o_orderstatus phase from {_ORDERS} where o_orderstatus = 'O' and contains(c_mktsegment, 'AUTO')")
def pattern_drafts_on_law(spark, sf):
    laws = _t(spark, sf, "customer").select(_iri("c", "c_custkey").alias("iri"), F.col("c_mktsegment").alias("title"))
    drafts = _orders(spark, sf).select("iri", F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("phase"))
    return Q.drafts_on_law(_edges(spark, sf), laws, drafts, "AUTO").select("src", "dst", "title", F.col("label").alias("label_text"), "phase")


@_register(f"select distinct iri law, 'c' || c_custkey directive from {_ORDERS} where o_orderstatus = 'P'")
def pattern_directive_pairs(spark, sf):
    return Q.directive_pairs(_edges(spark, sf))


@_register(f"select iri src from {_ORDERS} where o_orderstatus = 'P' and c_custkey = 5")
def pattern_transposing_laws(spark, sf):
    return Q.transposing_laws(_edges(spark, sf), "c5")


@_register("""
select 'lex:A' || (l_suppkey % 5) || '_Par_' || l_linenumber provision_iri, l_returnflag sanction_type, l_quantity max_penalty, l_orderkey from lineitem where l_suppkey % 5 = 2""")
def pattern_sanctions_of(spark, sf):
    s = _t(spark, sf, "lineitem").select(F.expr("'lex:A' || (l_suppkey % 5) || '_Par_' || l_linenumber").alias("provision_iri"), F.col("l_returnflag").alias("sanction_type"), F.col("l_quantity").alias("max_penalty"), "l_orderkey")
    return Q.sanctions_of(s, "lex:A2")


@_register(f"select iri src, 'c' || c_custkey dst, c_name as label_text from {_ORDERS}")
def pattern_authorities(spark, sf):
    e = _edges(spark, sf).withColumn("pred", F.lit("competentAuthority"))
    return Q.authorities(e, _t(spark, sf, "customer").select(_iri("c", "c_custkey").alias("iri"), F.col("c_name").alias("label"))).select("src", "dst", F.col("label").alias("label_text"))


@_register("select p_partkey from part where p_size <= 10 and p_partkey % 4 = 1")
def pattern_provisions_of_type(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", F.expr("'lex:L' || (p_partkey % 4) || '_Par_' || p_partkey").alias("iri"), F.when(F.col("p_size") <= 10, "Right").otherwise("Obligation").alias("normative_type"))
    return Q.provisions_of_type(p, "Right", "lex:L1").select("p_partkey")


@_register("select l_orderkey, 'e' || l_orderkey || '_' || l_linenumber dst, min(l_shipdate)::date::varchar amendment_day from lineitem where l_suppkey = 3 group by 1, 2")
def pattern_amendment_timeline(spark, sf):
    event = F.expr("'e' || l_orderkey || '_' || l_linenumber").alias("iri")
    li = _t(spark, sf, "lineitem").where("l_suppkey = 3 or l_suppkey = 4")
    events = li.where("l_suppkey = 3").groupBy(event, "l_orderkey").agg(F.min(F.to_date("l_shipdate")).alias("amendment_date")).withColumn("rt_reference", F.col("l_orderkey"))
    edges = li.select(_iri("law", "l_suppkey").alias("src"), F.lit("amendedBy").alias("pred"), event.alias("dst")).distinct()
    return Q.amendment_timeline(edges, events, "law3").select(F.col("rt_reference").alias("l_orderkey"), "dst", F.col("amendment_date").cast("string").alias("amendment_day"))


@_register(f"select iri from {_ORDERS} where o_orderstatus = 'O'")
def pattern_drafts_in_phase(spark, sf):
    return Q.drafts_in_phase(_orders(spark, sf).select("iri", F.col("o_orderstatus").alias("phase")), "O").select("iri")


@_register(f"select iri, iso_day from {_ORDERS} where o_orderpriority = '3-MEDIUM' and o_orderdate >= timestamp '1997-01-01'")
def pattern_review_decisions(spark, sf):
    d = _orders(spark, sf).select("iri", F.col("o_orderpriority").alias("case_type"), F.col("day").alias("decision_date"))
    return Q.review_decisions(d, "1997-01-01", "3-MEDIUM").select("iri", F.col("decision_date").cast("string").alias("iso_day"))


@_register(f"select iri, iso_day from {_ORDERS} where c_mktsegment = 'BUILDING' and o_orderpriority = '5-LOW' order by o_orderdate::date desc, iri limit 20")
def pattern_acts_by_institution(spark, sf):
    a = _orders(spark, sf).select("iri", F.array(F.lit("x"), "c_mktsegment").alias("authors"), F.col("o_orderpriority").alias("doc_type"), F.col("day").alias("document_date"))
    return Q.acts_by_institution(a, "BUILDING", "5-LOW").select("iri", F.col("document_date").cast("string").alias("iso_day"))


@_register("select 'o' || o_orderkey iri from orders join customer on o_custkey = c_custkey where c_nationkey = 4")
def pattern_provisions_on_topic(spark, sf):
    topics = _t(spark, sf, "customer").select(_iri("c", "c_custkey").alias("src"), F.lit("subject").alias("pred"), _iri("n", "c_nationkey").alias("dst"))
    p = _t(spark, sf, "orders").select(_iri("o", "o_orderkey").alias("iri"), _iri("c", "o_custkey").alias("law_iri"))
    return Q.provisions_on_topic(topics, p, "n4").select("iri")


@_register("select 'c' || c_custkey iri from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def pattern_union_classes(spark, sf):
    types = _t(spark, sf, "customer").select(_iri("c", "c_custkey").alias("iri"), F.col("c_mktsegment").alias("type"))
    return Q.union_classes(types, ["BUILDING", "MACHINERY"])


@_register("select c_custkey, split_part(c_name, '#', 2) number from customer where starts_with(c_name, 'Customer#00000001')")
def pattern_celex_starts(spark, sf):
    c = _t(spark, sf, "customer").withColumn("celex", F.col("c_name"))
    return Q.celex_starts(c, "Customer#00000001").select("c_custkey", Q.country_of(F.col("c_name"), "#").alias("number"))


@_register("select c_mktsegment institution, count(*)::bigint n_provisions, count(distinct c_nationkey)::bigint n_laws from customer group by 1")
def report_institutions(spark, sf):
    c = _t(spark, sf, "customer").select(F.lower("c_mktsegment").alias("suffix"), F.col("c_mktsegment").alias("name"), _iri("c", "c_custkey").alias("iri"), F.col("c_nationkey").alias("law"))
    return reports.institutions(c).select(F.col("name").alias("institution"), "n_provisions", "n_laws")


@_register("select year(o_orderdate)::int as yr, o_orderpriority case_type, count(*)::bigint n from orders group by 1, 2")
def report_by_year(spark, sf):
    o = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("decision_date"), F.col("o_orderpriority").alias("case_type"))
    return reports.by_year(o).withColumnRenamed("year", "yr")


@_register("select o_orderpriority doc_type, count(*)::bigint total, count_if(o_orderstatus = 'F')::bigint in_force, count_if(o_orderstatus <> 'F')::bigint not_in_force from orders group by 1")
def report_eu_acts(spark, sf):
    return reports.eu_acts(_t(spark, sf, "orders").select(F.col("o_orderpriority").alias("doc_type"), (F.col("o_orderstatus") == "F").alias("in_force")))


@_register("""
with x as (select c_custkey, coalesce(c_mktsegment = 'BUILDING', false) a from customer)
select c_custkey, case when a then 'Builders' else 'other ' || c_custkey end title from x""")
def with_computed_default(spark, sf):
    known = spark.createDataFrame([("BUILDING", "Builders")], "c_mktsegment string, title string")
    c = _t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return R.with_default(c, known, "c_mktsegment", "title", F.concat(F.lit("other "), F.col("c_custkey").cast("string"))).select("c_custkey", "title")
