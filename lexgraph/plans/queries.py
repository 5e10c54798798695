"""Queries of the graph operators over the driver's tables, by name, with the SQL that gives the same rows.

Every query runs over whole tables and whole texts. The operators are those of lexgraph.operators; here they are bound
to columns of customers, orders, documents and so on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import SEVERITY, STOPWORDS
from ..operators import classify as C
from ..operators import dedupe as U
from ..operators import entities as E
from ..operators import extract as X
from ..operators import graph as G
from ..operators import repair as P
from ..operators import resolve as R
from ..operators import similar as S
from ..operators import validate as V
from ..sources import readers
from . import graph_queries as Q
from . import layers, reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_KEYWORDS = f"list_distinct(list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-zäöüõšž]+'), lambda x: len(x) >= 4 and x not in ({_STOP})))"


@_register(f"""
with k as (select doc_id, source, {_KEYWORDS} ws from documents),
s as (select doc_id, source, len(ws) n, ws from k where len(ws) >= 3),
w as (select doc_id, source, n, unnest(ws) w from s),
p as (select a.doc_id a, b.doc_id b, a.n na, b.n nb, count(*) shared from w a join w b on a.w = b.w and a.doc_id < b.doc_id and a.source <> b.source group by all),
r as (select *, row_number() over (partition by a order by shared / (na + nb - shared) desc, b desc) rank from p where shared >= 3 and shared / (na + nb - shared) >= 0.3)
select a, b, na::bigint na, nb::bigint nb, shared::bigint shared, rank::bigint rank from r where rank <= 5""")
def keyword_similarity(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), F.col("source").alias("grp"), T.keywords(F.col("text")).alias("keywords"))
    out = S.keyword_similarity(d, 3, 0.3, 5)
    return out.select("a", "b", *(F.col(c).cast("bigint").alias(c) for c in ("na", "nb", "shared", "rank")))


@_register("""
with e as (select o_custkey, o_orderkey, o_totalprice from orders)
select o_custkey dst, count(*)::bigint n from e group by 1 order by n desc, dst limit 50""")
def in_degree_topk(spark, sf):
    e = _t(spark, sf, "orders").select(F.col("o_custkey").alias("dst"))
    return G.in_degree(e, 50)


@_register("""
select lang, count(*)::bigint n_docs, sum(case when regexp_matches(text, '(?i)licensed under|released under|all rights reserved|general public license') then 1 else 0 end)::bigint n_boilerplate
from documents group by 1""")
def boilerplate_filter(spark, sf):
    hit = C.matches_any(F.col("text"), ("licensed under", "released under", "all rights reserved", "general public license"))
    return _t(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(hit.cast("bigint")).alias("n_boilerplate"))


_DOMAINS = (("100", "tion", 1), ("100", "ing", 1), ("200", "keit", 2), ("200", "lich", 2), ("300", "ment", 1), ("300", "eau", 1), ("400", "ción", 3), ("500", "thing", 1))


@_register("""
with d(code, keyword, threshold) as (values ('100','tion',1),('100','ing',1),('200','keit',2),('200','lich',2),('300','ment',1),('300','eau',1),('400','ción',3),('500','thing',1)),
h as (select doc_id, code, threshold, sum(len(regexp_extract_all(lower(coalesce(text, '')), keyword))) hits from documents, d group by all)
select doc_id, code, hits::bigint hits, rank::bigint rank from (select *, row_number() over (partition by doc_id order by hits desc, code) rank from h where hits >= threshold) where rank <= 3""")
def keyword_hit_topk(spark, sf):
    d = spark.createDataFrame([(c, k, False, t) for c, k, t in _DOMAINS], "code string, keyword string, is_pattern boolean, threshold int")
    out = C.keyword_hits(_t(spark, sf, "documents"), "doc_id", "text", d, 3)
    return out.select("doc_id", "code", F.col("hits").cast("bigint").alias("hits"), F.col("rank").cast("bigint").alias("rank"))


@_register(r"""
with s as (select conv_id, turn,
  case when regexp_matches(lower(text), '(^|[^a-z])the([^a-z]|$)') then 2 else 0 end + case when regexp_matches(lower(text), '(^|[^a-z])and([^a-z]|$)') then 1 else 0 end a,
  case when regexp_matches(lower(text), '(^|[^a-z])der([^a-z]|$)') then 2 else 0 end + case when regexp_matches(lower(text), '(^|[^a-z])und([^a-z]|$)') then 1 else 0 end b,
  case when regexp_matches(lower(text), '(^|[^a-z])que([^a-z]|$)') then 2 else 0 end + case when regexp_matches(lower(text), '(^|[^a-z])la([^a-z]|$)') then 1 else 0 end c from conversations)
select conv_id, turn, case when greatest(a, b, c) <= 0 then null when a = greatest(a, b, c) then 'en' when b = greatest(a, b, c) then 'de' else 'romance' end class from s""")
def weighted_argmax_class(spark, sf):
    low = F.lower("text")
    score = lambda *ws: sum((F.when(low.rlike(f"(^|[^a-z]){w}([^a-z]|$)"), n).otherwise(0) for w, n in ws), F.lit(0))
    return _t(spark, sf, "conversations").select("conv_id", "turn", C.argmax({"en": score(("the", 2), ("and", 1)), "de": score(("der", 2), ("und", 1)), "romance": score(("que", 2), ("la", 1))}).alias("class"))


@_register("""
select p_partkey, case when p_name like '%ring%' then case when p_name like '%small%' then 'small ring' else 'ring' end when p_name like '%bolt%' then 'bolt' when p_name like '%widget%' then 'widget' else 'other' end class from part""")
def ordered_cascade_class(spark, sf):
    n = F.col("p_name")
    ring = F.when(n.contains("small"), "small ring").otherwise("ring")
    return _t(spark, sf, "part").select("p_partkey", F.when(n.contains("ring"), ring).otherwise(C.first_match(n, (("bolt", "bolt"), ("widget", "widget")), "other", "")).alias("class"))


@_register("""
select p_partkey, case substr(p_brand, 7, 1) when '1' then 'Criminal' when '2' then 'Civil' when '3' then 'Administrative' when '4' then 'Misdemeanor' when '5' then 'ConstitutionalReview' else 'Other' end case_type from part""")
def code_prefix_class(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", C.case_type(F.substring("p_brand", 7, 10)).alias("case_type"))


@_register(r"""
with c as (select n_nationkey src, 'N' || n_regionkey || ' § ' || n_nationkey || '-' || (n_nationkey + 12) || ' ja käesoleva seaduse § 0' || (n_nationkey % 7) || ', N9 § 1' t, n_regionkey own from nation),
a as (select src, 1 pattern, regexp_extract(t, 'N([0-4]) § ([0-9]+)-([0-9]+)', 1)::int pre, unnest(generate_series(regexp_extract(t, 'N([0-4]) § ([0-9]+)-([0-9]+)', 2)::bigint, regexp_extract(t, 'N([0-4]) § ([0-9]+)-([0-9]+)', 3)::bigint)) par from c
  union all select src, 2, own, regexp_extract(t, 'seaduse § ([0-9]+)', 1)::bigint from c),
i as (select n_regionkey pre, n_nationkey par from nation)
select distinct a.src::bigint src, i.par::bigint dst from a join i on a.pre = i.pre and a.par = i.par where a.src <> i.par""")
def citation_extract_resolve(spark, sf):
    n = _t(spark, sf, "nation")
    k, r = F.col("n_nationkey").cast("string"), F.col("n_regionkey").cast("string")
    text = F.concat(F.lit("N"), r, F.lit(" § "), k, F.lit("-"), (F.col("n_nationkey") + 12).cast("string"), F.lit(" ja käesoleva seaduse § 0"), (F.col("n_nationkey") % 7).cast("string"), F.lit(", N9 § 1"))
    names = {f"N{i}": f"N{i}" for i in range(5)}
    cites = X.citations(n.select(k.alias("iri"), r.alias("own_prefix"), text.alias("text")), abbreviations=names)
    index = n.select(r.alias("prefix"), k.alias("par_key"), k.alias("iri"))
    abbreviations = n.select(F.concat(F.lit("N"), r).alias("law_ref"), r.alias("prefix")).distinct()
    return R.resolve_citations(cites, index, abbreviations).select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))


@_register("select distinct c_nationkey::bigint src, 'hasCustomer' pred, c_custkey::bigint dst from customer where c_nationkey is not null and c_custkey is not null")
def inverse_edges(spark, sf):
    e = _t(spark, sf, "customer").select(F.col("c_custkey").alias("src"), F.col("c_nationkey").cast("bigint").alias("dst"))
    return G.invert(e, "hasCustomer")


@_register("""
with f as (select distinct o_orderkey src, o_custkey dst from orders), n as (select c_custkey dst from customer where c_custkey % 5 <> 0), b as (select distinct o_custkey dst, o_orderkey src from orders where o_orderkey % 7 <> 0)
select src, dst, 'missing target' issue from f anti join n using (dst)
union all select src, dst, 'no inverse' from (select * from f semi join n using (dst)) x anti join b using (src, dst)""")
def symmetry_check(spark, sf):
    o = _t(spark, sf, "orders")
    f = o.select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    nodes = _t(spark, sf, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("iri"))
    b = o.where("o_orderkey % 7 <> 0").select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    return G.symmetry_issues(f, b, nodes)


@_register("""
with e as (select 's' || n_nationkey src, (case when n_nationkey % 3 = 0 then 'OLD' else 'R' || n_regionkey end) || '_Par_' || n_nationkey dst from nation),
k as (select 'R' || n_regionkey || '_Par_' || n_nationkey iri from nation),
al(alias, canonical, priority) as (values ('OLD','R0',1),('OLD','R1',2),('OLD','R2',3),('OLD','R3',4)),
t as (select dst, arg_min(canonical || substr(dst, 4), priority) via from (select distinct dst from e where dst not in (select iri from k)) e join al on e.dst like alias || '\\_Par%' escape '\\' join k on k.iri = canonical || substr(dst, 4) group by 1)
select src, e.dst, coalesce(k.iri, t.via) target from e left join k on k.iri = e.dst left join t on t.dst = e.dst""".replace("\\\\", "\\"))
def alias_resolution(spark, sf):
    n = _t(spark, sf, "nation")
    k, r = F.col("n_nationkey").cast("string"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string"))
    e = n.select(F.concat(F.lit("s"), k).alias("src"), F.concat(F.when(F.col("n_nationkey") % 3 == 0, F.lit("OLD")).otherwise(r), F.lit("_Par_"), k).alias("dst"))
    aliases = spark.createDataFrame([("OLD", f"R{i}", i + 1) for i in range(4)], "alias string, canonical string, priority int")
    return R.resolve_aliases(e, n.select(F.concat(r, F.lit("_Par_"), k).alias("iri")), aliases)


@_register("""
with l(key, ord) as (values ('red widget',0),('widget',1),('blue_bolt',2),('small shiny ring',3),('green heavy bolt',4)),
n as (select distinct p_name, replace(lower(p_name), ' ', '_') slug from part),
p as (select p_name, key, ord, case when slug = key then 1 when contains(key, slug) or contains(slug, key) then 2
   when len(list_intersect(string_split(lower(p_name), ' '), string_split(key, ' '))) >= 2 then 3 end tier,
   case when slug = key or contains(key, slug) or contains(slug, key) then 0 else len(list_intersect(string_split(lower(p_name), ' '), string_split(key, ' '))) end score from n, l),
b as (select * from (select *, row_number() over (partition by p_name order by tier, score desc, ord) rn from p where tier is not null) where rn = 1)
select p_partkey, p_name, key, tier::int tier from part left join b using (p_name)""")
def fuzzy_tier_match(spark, sf):
    laws = spark.createDataFrame([("red widget", 0), ("widget", 1), ("blue_bolt", 2), ("small shiny ring", 3), ("green heavy bolt", 4)], "key string, ord int")
    return R.draft_to_law(_t(spark, sf, "part").select("p_partkey", "p_name"), laws, "p_name").select("p_partkey", "p_name", "key", "tier")


@_register()
def edit_distance_band(spark, sf):
    """Links of all words of 4 letters or more at a distance of 1 or 2. All pairs of words are too many for SQL; tests compare
    with all pairs of a small table."""
    w = _t(spark, sf, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("w")).distinct()
    out = S.near_terms(w.select(F.col("w").alias("iri"), F.col("w").alias("term_lower"), F.col("w").alias("ord")))
    return out.select("term_a", "term_b", F.col("distance").cast("bigint").alias("distance"))


@_register("""
with w as (select distinct source, w from (select source, unnest(regexp_extract_all(lower(text), '[a-z]+')) w from documents))
select w term, count(*)::bigint n_sources, min(source) first_source from w group by 1 having count(*) > 1""")
def exact_term_multi_source(spark, sf):
    w = _t(spark, sf, "documents").select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("term"))
    return reports.terms_of_several(w, "term", "source").withColumnsRenamed({"n": "n_sources", "first": "first_source"})


@_register("""
with c as (select o_orderpriority law, o_custkey || '/' || o_orderstatus term, o_orderkey ord from orders),
m as (select term from c group by 1 having count(distinct law) > 1)
select a.ord src, b.ord dst, a.term term_lower from c a join c b on a.term = b.term and a.ord < b.ord where a.term in (select term from m)""")
def shared_term_links(spark, sf):
    """Terms are a customer's orders of one status, so that their links grow with the table."""
    o = _t(spark, sf, "orders")
    return S.shared_terms(o.select(F.col("o_orderkey").alias("iri"), F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderstatus").alias("term_lower"), F.col("o_orderpriority").alias("law"), F.col("o_orderkey").alias("ord")))


@_register("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) rn from orders) where rn = 1")
def dedupe_keep_first(spark, sf):
    return U.keep_first(_t(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@_register("select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) rn from orders) where rn = 1")
def dedupe_keep_last(spark, sf):
    return U.keep_last(_t(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@_register("select o_orderkey, 'C' || o_custkey || case when rn > 1 then '_' || rn else '' end iri from (select *, row_number() over (partition by o_custkey order by o_orderkey) rn from orders)")
def suffix_numbering(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("iri"))
    return U.suffix_collisions(o, "iri", ["o_orderkey"])


@_register("""
with l as (select *, row_number() over (partition by l_returnflag order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 seen, row_number() over (partition by l_returnflag, l_suppkey order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) rn from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_suppkey || case when rn > 1 then '_' || seen else '' end iri from l""")
def running_seen_suffix(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("iri", F.col("l_suppkey").cast("string"))
    out = U.suffix_seen(li, ["l_returnflag"], "iri", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "iri")


@_register("select o_custkey::varchar title, max(o_orderkey::varchar) gid, arg_max(o_totalprice, o_orderkey::varchar) price from orders group by 1")
def latest_by_string_version(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("title"), F.col("o_orderkey").cast("string").alias("gid"), F.col("o_totalprice").alias("price"))
    return readers.latest_versions(o).select("title", "gid", "price")


@_register("""
with s as (select case when o_orderstatus = 'F' and o_orderdate <= timestamp '1998-01-01' then 'repealed' when o_orderdate > timestamp '1998-01-01' then 'notYetEffective' else 'inForce' end status from orders),
d(status) as (values ('inForce'),('repealed'),('notYetEffective'),('unknown'))
select status, count(s.status)::bigint n from d left join s using (status) group by 1""")
def temporal_status(spark, sf):
    o = _t(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    status = C.temporal_status(F.when(F.col("o_orderstatus") == "F", day), F.lit(None).cast("date"), day, F.lit("1998-01-01").cast("date"))
    dim = spark.createDataFrame([("inForce",), ("repealed",), ("notYetEffective",), ("unknown",)], "status string")
    n = o.select(status.alias("status")).groupBy("status").agg(F.count("*").alias("k"))
    return dim.join(n, "status", "left").select("status", F.coalesce("k", F.lit(0)).cast("bigint").alias("n"))


@_register("select o_orderkey, case when o_orderkey % 5 = 4 then null else strftime(o_orderdate, '%Y-%m-%d') end as iso_day from orders")
def date_normalization(spark, sf):
    d = F.col("o_orderdate")
    forms = F.when(F.col("o_orderkey") % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderkey") % 5 == 1, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("+02:00"))).when(
        F.col("o_orderkey") % 5 == 2, F.date_format(d, "d.M.yyyy")).when(F.col("o_orderkey") % 5 == 3, F.concat(F.date_format(d, "yyyy"), F.lit("+03:00"), F.date_format(d, "-MM-dd"))).otherwise(F.lit("n.d."))
    return _t(spark, sf, "orders").select("o_orderkey", F.date_format(T.parse_date(forms), "yyyy-MM-dd").alias("iso_day"))


@_register("""
with s as (select o_custkey law, 6 - substr(o_orderpriority, 1, 1)::int sev from orders)
select law, count(*)::bigint n, max(sev)::bigint max_severity, ['coercive_payment', 'fine', 'pecuniary_punishment', 'arrest', 'imprisonment'][max(sev)] max_type from s group by 1 order by max_severity desc, n desc, law limit 50""")
def severity_max(spark, sf):
    kinds = F.array(*(F.lit(k) for k in sorted(SEVERITY, key=SEVERITY.get)))
    s = _t(spark, sf, "orders").select(F.col("o_custkey").alias("law"), F.get(kinds, 5 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("sanction_type"))
    return reports.severity(s).withColumn("max_severity", F.col("max_severity").cast("bigint"))


@_register("""
select n_name title, count(*)::bigint n from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1 order by n desc, title limit 30""")
def two_level_amendment_total(spark, sf):
    titles = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("law_iri"), F.col("n_name").alias("title"))
    return reports.amendments(_t(spark, sf, "orders").select(F.col("o_custkey").alias("law_iri")), titles)


@_register("""
with l as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) ord from lineitem),
a as (select l_orderkey, l_suppkey, min(ord) first from l group by 1, 2)
select l_orderkey celex, string_agg(l_suppkey::varchar, ',' order by first) authors, (select l_shipdate::date::varchar from l where l.l_orderkey = a.l_orderkey and ord = 1) shipped from a group by 1""")
def author_merge(spark, sf):
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    b = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("celex"), F.concat(F.lit("http://lex.example/authority/"), F.col("l_suppkey").cast("string")).alias("author"), order.alias("ord"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))
    return E.merge_authors(b).select("celex", F.array_join("authors", ",").alias("authors"), "shipped")


@_register("""
select c_nationkey, string_agg(o_orderkey::varchar, ',' order by o_orderkey) orders from (select c_nationkey, o_orderkey, row_number() over (partition by c_nationkey order by o_orderkey) rn from orders join customer on o_custkey = c_custkey) where rn <= 50 group by 1""")
def capped_list(spark, sf):
    j = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.col("o_orderkey").cast("string").alias("k"), "o_orderkey")
    return U.capped_list(j, ["c_nationkey"], "k", ["o_orderkey"], 50, "l").select("c_nationkey", F.array_join("l", ",").alias("orders"))


@_register("""
select o_orderstatus decision_type, o_orderpriority court, year(o_orderdate)::varchar category, count(*)::bigint n from orders group by grouping sets ((o_orderstatus), (o_orderpriority), (year(o_orderdate)))""")
def grouping_sets_counts(spark, sf):
    o = _t(spark, sf, "orders")
    return reports.eu_decisions(o.select(F.col("o_orderstatus").alias("decision_type"), F.col("o_orderpriority").alias("court"), F.year("o_orderdate").cast("string").alias("category")))


@_register("select p_partkey, case when p_size between 1 and 12 then 'A' when p_size between 10 and 30 then 'B' when p_size between 25 and 45 then 'C' end cluster from part")
def first_match_range_cluster(spark, sf):
    c = spark.createDataFrame([("A", 0, list(range(1, 13))), ("B", 1, list(range(10, 31))), ("C", 2, list(range(25, 46)))], "cluster string, pos int, numbers array<int>")
    return R.range_cluster(_t(spark, sf, "part"), "p_size", c).select("p_partkey", "cluster")


@_register("""
with i as (select distinct 'lex:' || replace(p_name, ' ', '_') || '_Par' || p_size iri from part)
select iri, 'lex:' || case when iri like 'lex:red\\_widget\\_%' escape '\\' then 'RW' || substr(iri, 15) when iri like 'lex:red\\_%' escape '\\' then 'R' || substr(iri, 8) when iri like 'lex:blue\\_%' escape '\\' then 'BLUE' || substr(iri, 9) else substr(iri, 5) end new_raw from i""".replace("\\\\", "\\").replace(
    "select iri, 'lex:'", "select iri, regexp_replace('lex:'").replace("end new_raw", "end, '_Par([0-9])', '_Par_\\1') new_iri"))
def longest_prefix_rename(spark, sf):
    iris = _t(spark, sf, "part").select(F.concat(F.lit("lex:"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_Par"), F.col("p_size").cast("string")).alias("iri"))
    reg = spark.createDataFrame([("a", "R", "red"), ("b", "RW", "red_widget"), ("c", "BLUE", "blue")], "slug string, abbrev string, old_prefix string")
    return R.rename_map(iris, reg, "lex")


@_register("""
with p as (select distinct 'c' || o_custkey || '_osa1' slug from orders where o_orderpriority = '1-URGENT' union all select 'a_very_long_name_of_an_act_' || o_custkey from orders where o_custkey % 7 = 0),
w as (select c_custkey, 'c' || c_custkey slug from customer union all select -1 - c_custkey, case when c_custkey % 2 = 0 then 'a_very_long_name_of_another_' else 'some_other_long_name_of_an_act_' end || c_custkey from customer)
select c_custkey, slug from w where not exists (select 1 from p where starts_with(p.slug, left(w.slug, 20)))""")
def anti_incremental(spark, sf):
    """Short slugs that begin a present one, long ones that agree in 20 characters, and slugs that are new."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    present = o.where("o_orderpriority = '1-URGENT'").select(F.expr("'c' || o_custkey || '_osa1'").alias("slug")).unionByName(o.where("o_custkey % 7 = 0").select(F.expr("'a_very_long_name_of_an_act_' || o_custkey").alias("slug")))
    wanted = c.select("c_custkey", F.expr("'c' || c_custkey").alias("slug")).unionByName(
        c.select((-1 - F.col("c_custkey")).alias("c_custkey"), F.expr("case when c_custkey % 2 = 0 then 'a_very_long_name_of_another_' else 'some_other_long_name_of_an_act_' end || c_custkey").alias("slug")))
    return R.not_yet_present(wanted, "slug", present)


@_register("select md5(text) iri, string_agg(distinct source, ',' order by source) files from documents group by 1 having count(distinct source) > 1")
def duplicate_id_report(spark, sf):
    d = _t(spark, sf, "documents").select(F.md5(F.col("text")).alias("iri"), F.col("source").alias("file_name"))
    return P.duplicate_ids(d).select("iri", F.array_join("files", ",").alias("files"))


@_register("""
with d as (select doc_id, count(l.doc_id) n, min(quality) q from documents left join labels l using (doc_id) group by 1)
select doc_id::varchar iri, 'Document' shape, 'quality' path, 'minCount' kind, '0' observed from d where q is null
union all select event_id::varchar, 'Event', 'k', 'datatype', 'string' from events where try_cast(json_extract_string(props, '$.k') as int) is null
union all select event_id::varchar, 'Event', 'small', 'maxCount', '1' from events where try_cast(json_extract_string(props, '$.k') as int) < 10""")
def shape_violations(spark, sf):
    d, l, e = _t(spark, sf, "documents"), _t(spark, sf, "labels"), _t(spark, sf, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    i = F.col("event_id").cast("string").alias("iri")
    values = l.select(F.col("doc_id").cast("string").alias("iri"), F.lit("quality").alias("path"), F.col("quality").cast("string").alias("value"), F.lit("int").alias("datatype"))
    values = values.unionByName(e.select(F.concat(F.lit("e"), i).alias("iri"), F.lit("k").alias("path"), F.get_json_object("props", "$.k").alias("value"), F.when(k.isNull(), "string").otherwise("int").alias("datatype")))
    values = values.unionByName(e.where(k < 10).select(F.concat(F.lit("e"), i).alias("iri"), F.lit("small").alias("path"), k.cast("string").alias("value"), F.lit("int").alias("datatype")))
    types = d.select(F.col("doc_id").cast("string").alias("iri"), F.lit("Document").alias("type")).unionByName(e.select(F.concat(F.lit("e"), i).alias("iri"), F.lit("Event").alias("type")))
    rules = spark.createDataFrame([("Document", "Document", "quality", 1, None, "int", None), ("Event", "Event", "k", 1, 1, "int", None), ("Event", "Event", "small", None, 0, None, None)], "shape string, target string, path string, least int, most int, datatype string, kind string")
    return V.violations(values, types, rules).withColumn("iri", F.regexp_replace("iri", "^e", ""))


@_register("""
with c as (select conv_id, turn, role, text, '<tr><td>' || turn || '</td><td>' || role || '</td><td>' || length(coalesce(text, '')) || '</td><td>' || conv_id || '</td></tr>' r from conversations)
select conv_id, count(*)::bigint n_rows, string_agg(turn || '/' || role || '/' || length(coalesce(text, '')) || '/' || conv_id, ';' order by turn, role, length(coalesce(text, ''))) cells from c group by 1""")
def html_rows(spark, sf):
    """Conversations as result pages with a table row per turn and a heading row, whose cells are read again."""
    row = F.concat(F.lit("<tr class='r'><td>"), F.col("turn").cast("string"), F.lit("</td><td>"), "role", F.lit("</td><td>"), F.length(F.coalesce("text", F.lit(""))).cast("string"), F.lit("</td>\n<td>"), F.col("conv_id").cast("string"), F.lit("</td></tr>"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.length(F.coalesce("text", F.lit(""))).alias("n"), row.alias("r"))))
    pages = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda x: x.r), "\n").alias("t"))
    pages = pages.select("conv_id", F.concat(F.lit("<table><tr><th>a</th><td>b</td></tr>"), "t", F.lit("</table>")).alias("html"))
    rows = pages.select("conv_id", readers.html_rows(F.col("html")).alias("r"))
    return rows.select("conv_id", F.size("r").cast("bigint").alias("n_rows"), F.array_join(F.transform("r", lambda c: F.array_join(c, "/")), ";").alias("cells"))


@_register("select event_type, count(*)::bigint n, sum(json_extract_string(props, '$.k')::bigint)::bigint total, max(json_extract_string(props, '$.k')::bigint)::bigint top from events group by 1")
def json_property_bag(spark, sf):
    """Properties of graph nodes: every event is a document with one node."""
    d = _t(spark, sf, "events").select(F.col("event_type").alias("file_name"), F.try_parse_json(F.concat(F.lit('{"@graph": ['), "props", F.lit("]}"))).alias("v"))
    k = readers.nodes(d).select(F.col("file_name").alias("event_type"), readers.value_of("k").cast("bigint").alias("k"))
    return k.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total"), F.max("k").alias("top"))


@_register("select conv_id::varchar file_name, string_agg(concat_ws(' ', role, lower(text)), ' ' order by turn, concat_ws(' ', role, lower(text))) as text from conversations group by 1")
def ordered_text_assembly(spark, sf):
    c = _t(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("file_name"), F.col("turn").alias("pos"), "role", F.lower("text").alias("said"))
    return layers.file_texts(c, "role", "said")


_SLUG = "left(trim(regexp_replace(lower(translate({0}, 'öäüõÖÄÜÕšžŠŽ', 'oauoOAUOszSZ')), '[^a-z0-9]+', '_', 'g'), '_'), 80)"


@_register(f"select doc_id, {_SLUG.format('text')} slug, case when regexp_replace(translate(replace(source, ' ', '_'), 'öäüõÖÄÜÕšžŠŽ', 'oauoOAUOszSZ'), '[^0-9A-Za-z_]', '', 'g') = '' then 'Unknown' else source end safe from documents")
def slugify_translit(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.slugify(F.col("text")).alias("slug"), T.sanitize_id(F.col("source")).alias("safe"))


@_register("""
select 'o' || o_orderkey src, o_orderpriority case_number, o_orderdate::date::varchar iso_day from orders join customer on o_custkey = c_custkey where c_nationkey = 1 and o_orderstatus = 'F'""")
def bgp_two_hop_topk(spark, sf):
    """Who interprets one identifier, newest first."""
    o = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    iri = F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))
    edges = o.select(iri.alias("src"), F.when(F.col("o_orderstatus") == "F", "interpretsLaw").otherwise("references").alias("pred"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("dst"))
    decisions = o.select(iri.alias("iri"), F.col("o_orderpriority").alias("case_number"), F.to_date("o_orderdate").alias("decision_date"))
    return Q.interpretations(edges, decisions, "n1").select("src", "case_number", F.date_format("decision_date", "yyyy-MM-dd").alias("iso_day"))


@_register("""
with recursive p(cls, parent) as (select n_name, r_name from nation join region on n_regionkey = r_regionkey union all select r_name, 'WORLD' from region),
c(cls, ancestor, distance) as (select x, x, 0 from (select cls x from p union select parent from p) union all select c.cls, p.parent, distance + 1 from c join p on c.ancestor = p.cls where distance < 2)
select cls, ancestor, min(distance)::int distance from c group by 1, 2""")
def subclass_closure(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    p = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("cls"), F.col("r_name").alias("parent")).unionByName(r.select(F.col("r_name").alias("cls"), F.lit("WORLD").alias("parent")))
    return G.subclass_closure(p, 2)


_CLAUSES = (
    (1, "kuue- kuni viieteistaastase vangistusega"), (2, "karistatakse rahalise karistusega või kuni viieaastase vangistusega"), (3, "rahatrahviga kuni kolmsada trahviühikut või arestiga"),
    (4, "sunniraha kuni 2000 eurot"), (5, "karistatakse arestiga"), (6, "midagi muud"), (7, "eluaegse vangistusega"),
)


@_register("""
with e(clause, ord, sanction_type, max_penalty, min_penalty) as (values (1,0,'imprisonment','15 years','6 years'),(2,0,'imprisonment','5 years',null),(2,1,'pecuniary_punishment','500 daily rates',null),
(3,0,'fine','300 fine units',null),(3,1,'arrest','30 days',null),(4,0,'coercive_payment','2000 EUR',null),(5,0,'arrest','30 days',null),(7,0,'imprisonment','life',null))
select o_orderkey, e.* from orders join e on clause = o_orderkey % 7 + 1""")
def sanction_extract(spark, sf):
    """Clauses are extracted once each; orders only refer to them."""
    found = X.sanctions(spark.createDataFrame(_CLAUSES, "clause int, text string"))
    o = _t(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7 + 1).cast("int").alias("clause"))
    return o.join(F.broadcast(found), "clause").select("o_orderkey", "clause", "ord", "sanction_type", "max_penalty", "min_penalty")


@_register("""
with f as (select o_custkey src, o_orderkey dst from orders), g as (select o_custkey dst, o_orderkey src from orders where o_orderstatus <> 'P')
select distinct f.src, f.dst from f join g on f.src = g.dst and f.dst = g.src""")
def mutual_edges(spark, sf):
    o = _t(spark, sf, "orders")
    f = o.select(F.col("o_custkey").alias("src"), F.lit("has").alias("pred"), F.col("o_orderkey").alias("dst"))
    b = o.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("src"), F.lit("of").alias("pred"), F.col("o_custkey").alias("dst"))
    return G.mutual(f.unionByName(b), "has", "of")


@_register("""
with p as (select o_orderstatus law, case substr(o_orderpriority, 1, 1) when '1' then 'Obligation' when '2' then 'Right' when '3' then 'Permission' when '4' then 'Prohibition' end kind from orders)
select law, count_if(kind = 'Obligation')::bigint "Obligation", count_if(kind = 'Right')::bigint "Right", count_if(kind = 'Permission')::bigint "Permission", count_if(kind = 'Prohibition')::bigint "Prohibition",
 count(kind)::bigint classified, count(*)::bigint total, printf('%.1f%%', 100.0 * count(kind) / count(*)) rate from p group by 1""")
def class_pivot(spark, sf):
    kinds = F.array(*(F.lit(k) for k in ("Obligation", "Right", "Permission", "Prohibition")))
    o = _t(spark, sf, "orders").select(F.col("o_orderstatus").alias("law"), F.get(kinds, F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("kind"))
    return reports.norm_types(o, "law", "kind")


@_register()
def nfkd_names(spark, sf):
    """Compatibility decomposition has no SQL: customers' segments with accents put in, decomposed."""
    return _t(spark, sf, "customer").select("c_custkey", T.normalize_text(F.translate("c_mktsegment", "AUO", "ÄÜÖ")).alias("segment"))


@_register("select 'N' || n_regionkey iri, min(n_name) name, count(*)::bigint copies from nation group by 1")
def combined_first_node(spark, sf):
    """First node per identifier over files (regions as ids, nations as files), with the number of its copies."""
    from ..sources import writers

    n = _t(spark, sf, "nation").select(F.col("n_name").alias("file_name"), F.col("n_nationkey").alias("pos"), F.concat(F.lit("N"), F.col("n_regionkey").cast("string")).alias("iri"), F.col("n_name").alias("name"))
    copies = n.groupBy("iri").agg(F.count("*").alias("copies"))
    return writers.combined_graph(n).join(copies, "iri").select("iri", "name", "copies")


@_register("""
select regexp_extract(replace(f, '_peep.json', ''), '^(.+?)(_osa[0-9]+.*)?$', 1) as name, string_agg(distinct f, ',' order by f) as files
from (select 'law' || (o_custkey % 40) || case when o_orderkey % 3 > 0 then '_osa' || (o_orderkey % 3) else '' end || '_peep.json' f from orders) group by 1""")
def law_registry(spark, sf):
    part = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("_osa"), (F.col("o_orderkey") % 3).cast("string"))).otherwise("")
    d = _t(spark, sf, "orders").select(F.concat(F.lit("law"), (F.col("o_custkey") % 40).cast("string"), part, F.lit("_peep.json")).alias("file_name"))
    return readers.law_registry(d).select("name", F.array_join("files", ",").alias("files"))


@_register("""
with p as (select unnest(range(0, 10)) t), s as (select floor(o_totalprice / 500000 * 10) / 10 b from orders)
select printf('%.1f', b) bucket, count(*)::bigint n from s group by 1""")
def similarity_tenths(spark, sf):
    s = _t(spark, sf, "orders").select((F.col("o_totalprice") / 500000).alias("similarity"))
    return s.groupBy(T.bucket(F.col("similarity")).alias("bucket")).agg(F.count("*").alias("n"))


@_register("select c_nationkey::bigint dst, string_agg(c_custkey::varchar, ',' order by c_custkey) sources from customer group by 1")
def adjacency_lists(spark, sf):
    c = _t(spark, sf, "customer")
    e = c.select(F.col("c_custkey").cast("string").alias("src"), F.col("c_nationkey").cast("bigint").alias("dst"), F.col("c_custkey").alias("ord")).unionByName(c.select(F.col("c_custkey").cast("string").alias("src"), F.col("c_nationkey").cast("bigint").alias("dst"), (F.col("c_custkey") + 1000000).alias("ord")))
    return G.adjacency(e).select("dst", F.array_join("sources", ",").alias("sources"))


@_register("""
with m as (select 'slug' || n_nationkey k, n_name v from nation where n_nationkey % 2 = 0),
f as (select p_partkey, 'slug' || (p_partkey % 25) || case when p_partkey % 3 = 0 then '_osa1' else '' end slug from part)
select p_partkey, slug, coalesce(a.v, b.v) v from f left join m a on a.k = slug left join m b on b.k = regexp_replace(slug, '_osa[0-9]+.*$', '')""")
def chained_key_join(spark, sf):
    n = _t(spark, sf, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("slug"), F.col("n_nationkey").cast("string")).alias("k"), F.col("n_name").alias("v"))
    slug = F.concat(F.lit("slug"), (F.col("p_partkey") % 25).cast("string"), F.when(F.col("p_partkey") % 3 == 0, F.lit("_osa1")).otherwise(""))
    return R.coalesced_join(_t(spark, sf, "part").select("p_partkey", slug.alias("slug")), n, [F.col("slug"), T.base_slug(F.col("slug"))], "k", ["v"])


@_register("""
with e as (select o_custkey k, 'x' || (o_orderkey % 4) v, o_orderkey ord from orders where o_orderstatus = 'O'), w as (select o_custkey k, 'x' || (o_orderkey % 6) v, o_orderkey ord from orders where o_orderstatus = 'F'),
b as (select k, v, min(s * 1000000000 + ord) o from (select *, 0 s from e union all select *, 1 s from w) group by 1, 2)
select k, string_agg(v, ',' order by o) as merged from b group by 1""")
def merge_append_refs(spark, sf):
    o = _t(spark, sf, "orders")
    side = lambda status, n: o.where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"), F.concat(F.lit("x"), (F.col("o_orderkey") % n).cast("string")).alias("v"), F.col("o_orderkey").alias("ord"))
    return G.merge_append(side("O", 4), side("F", 6), "k", "v").select("k", F.array_join("v", ",").alias("merged"))


@_register("select distinct o_custkey src, o_orderpriority dst from orders where o_orderstatus = 'O' and (o_custkey, o_orderpriority) not in (select (o_custkey, o_orderpriority) from orders where o_orderstatus = 'F')")
def existing_minus_new(spark, sf):
    o = _t(spark, sf, "orders")
    side = lambda s: o.where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("src"), F.col("o_orderpriority").alias("dst")).distinct()
    return G.existing_minus(side("O"), side("F"))


@_register("""
with m as (select distinct 'D' || (l_suppkey % 30) celex_dir, l_shipmode country_code, 'N' || (l_partkey % 50) celex_nat from (select *, case l_linenumber % 3 when 0 then 'FI' when 1 then 'LV' else 'LT' end l_shipmode from lineitem)),
t as (select distinct 'D' || n_nationkey celex_dir from nation)
select celex_dir, country_code, row_number() over (partition by celex_dir, country_code order by celex_nat)::bigint idx, celex_nat from m semi join t using (celex_dir)""")
def harmonisation_measures(spark, sf):
    from ..operators import entities as E

    country = F.when(F.col("l_linenumber") % 3 == 0, "FI").when(F.col("l_linenumber") % 3 == 1, "LV").otherwise("LT")
    m = _t(spark, sf, "lineitem").select(F.concat(F.lit("D"), (F.col("l_suppkey") % 30).cast("string")).alias("celex_dir"), country.alias("country_code"), F.concat(F.lit("N"), (F.col("l_partkey") % 50).cast("string")).alias("celex_nat"))
    t = _t(spark, sf, "nation").select(F.concat(F.lit("D"), F.col("n_nationkey").cast("string")).alias("celex_dir"), F.col("n_name").alias("law_name"))
    return E.harmonisation(m, t, "lex").select("celex_dir", "country_code", F.col("idx").cast("bigint").alias("idx"), "celex_nat")


@_register("""
with d(country_code) as (values ('AFRICA'),('EUROPE'),('NOWHERE')) select country_code, count(r_name)::bigint n from d left join (select r_name from nation join region on n_regionkey = r_regionkey) on r_name = country_code group by 1""")
def zero_filled_counts(spark, sf):
    from . import reports

    n = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("country_code"))
    links = n.select(F.col("country_code").alias("celex_dir"), F.col("country_code").alias("law"))
    return reports.transposition(links, n, ["AFRICA", "EUROPE", "NOWHERE"])[1].select("country_code", "n")


@_register("""
select c_custkey iri, n_name nation, o.o_orderkey first_order from customer left join nation on c_nationkey = n_nationkey and n_regionkey = 0
left join (select o_custkey, min(o_orderkey) o_orderkey from orders where o_orderstatus = 'P' group by 1) o on o.o_custkey = c_custkey order by c_custkey limit 100 offset 50""")
def optional_pattern_page(spark, sf):
    from . import graph_queries as Q

    c = _t(spark, sf, "customer")
    n = c.join(_t(spark, sf, "nation").where("n_regionkey = 0"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("iri"), F.col("n_name").alias("nation"))
    o = _t(spark, sf, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("iri")).agg(F.min("o_orderkey").alias("first_order"))
    return Q.optional_pattern(c.select(F.col("c_custkey").alias("iri")), "iri", {"nation": n, "first_order": o}, 100, 50)


@_register("""
with i as (select 'lex:' || split_part(p_name, ' ', 1) || '_x' iri from part), r(iri, new_iri) as (values ('lex:red_x', 'lex:R_x'), ('lex:blue_x', 'lex:R_x'), ('lex:green_x', 'lex:G_x'))
select coalesce(r.new_iri, i.iri) new_iri, count(*)::bigint n from (select distinct iri from i) i left join r using (iri) group by 1 having count(*) > 1""")
def migration_collisions(spark, sf):
    i = _t(spark, sf, "part").select(F.concat(F.lit("lex:"), F.substring_index("p_name", " ", 1), F.lit("_x")).alias("iri"))
    r = spark.createDataFrame([("lex:red_x", "lex:R_x"), ("lex:blue_x", "lex:R_x"), ("lex:green_x", "lex:G_x")], "iri string, new_iri string")
    return R.collisions(r, i)


@_register("""
with l as (select doc_id, case when n_chars % 3 = 0 then '' else source end t, text from documents)
select doc_id, coalesce(nullif(t, ''), nullif(case when length(text) > 80 then rtrim(left(text, 80)) || '...' else text end, ''), '§') as label_text from l""")
def provision_labels(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", T.label(F.when(F.col("n_chars") % 3 == 0, "").otherwise(F.col("source")), F.col("text"), F.lit("§")).alias("label_text"))


@_register("""
with o as (select *, ((o_orderkey * 37) % 100 + 1)::int v from orders),
e as (select *, greatest(0, v + o_custkey % 60 - 5) e from o)
select o_orderkey, v || '-' || e num, case when e - v > 50 then regexp_replace(v || '-' || e, '[^0-9]', '', 'g') when e < v then '' else array_to_string(generate_series(v, e), ',') end as expanded from e""")
def range_expansion(spark, sf):
    o = _t(spark, sf, "orders").withColumn("v", ((F.col("o_orderkey") * 37) % 100 + 1).cast("int")).withColumn("e", F.greatest(F.lit(0), F.col("v") + F.col("o_custkey") % 60 - 5))
    num = F.concat_ws("-", F.col("v").cast("string"), F.col("e").cast("string"))
    return o.select("o_orderkey", num.alias("num"), F.array_join(T.expand_range(num), ",").alias("expanded"))


@_register("""
select c_custkey, left(regexp_replace(c_name, '[^0-9A-Za-z]', '', 'g'), 40) celex, c_mktsegment || ', max ' || case when c_custkey % 3 = 2 then '2 years' else '1 year' end label_text from customer""")
def codes_and_labels(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", T.sanitize_celex(F.col("c_name")).alias("celex"), X.sanction_label(F.col("c_mktsegment"), F.when(F.col("c_custkey") % 3 == 0, F.lit("1 years")).otherwise(F.concat((F.col("c_custkey") % 3).cast("string"), F.lit(" years"))), F.lit(None).cast("string"), F.lit("")).alias("label_text"))
