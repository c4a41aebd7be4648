"""Training-set curation, set operations and catalog completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators import curation, spatial
from starfold.plans.catalogue import query
from starfold.plans.roles import PREDICTIONS, place, positions, predictions, separation, table

MAPPER = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "absent": "absent"}
LISTS = "votes as (select o_custkey as id, o_orderpriority as classification, sum(o_orderkey % 5 - 1) as votes from orders group by all)"


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("classification"), (F.col("o_orderkey") % 5 - 1).alias("votes"))


@query("label_lists", f"with {LISTS} select id, string_agg(classification, ';' order by classification) as classification, string_agg(votes::bigint::varchar, ';' order by classification) as votes from votes group by id")
def label_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.join_lists(votes(spark, sf_dir))


def expected(label: str, name: str, gate: str) -> str:
    return f"coalesce(max(case when classification = '{name}'{gate} then 0.5::double * (1 + id % 2) end), 0) as {label}"


def expand_sql(gate: str) -> str:
    return f"with {LISTS} select id, " + ", ".join(expected(v, k, gate) for k, v in MAPPER.items()) + " from votes group by id"


def label_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = curation.join_lists(votes(spark, sf_dir))
    p = F.transform(F.split("classification", ";"), lambda _: (0.5 * (1 + F.col("id") % 2)).cast("string"))
    return lists.withColumn("probability", F.array_join(p, ";"))


@query("label_expand", expand_sql(""))
def label_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.expand_labels(label_sources(spark, sf_dir), MAPPER)


@query("label_expand_votes", expand_sql(" and votes >= 1"))
def label_expand_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.expand_labels(label_sources(spark, sf_dir), MAPPER, min_votes=1)


CLAIM = 6.0


@query(
    "ambiguous_match",
    f"""with t as (select {place('s_suppkey')} from supplier), c as (select {place('c_custkey')} from customer), p as (select t.id as source, c.id as rid, t.ra, t.dec, c.ra as r_ra, c.dec as r_dec from t join c on abs(t.dec - c.dec) <= {CLAIM} and {separation('t.ra', 't.dec', 'c.ra', 'c.dec')} <= {CLAIM})
select source, rid, claims from (select *, count(*) over (partition by rid) as claims, row_number() over (partition by rid order by (ra - r_ra) * (ra - r_ra) + (dec - r_dec) * (dec - r_dec), source) as n from p) where n = 1""",
)
def ambiguous_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = positions(spark, sf_dir, "supplier", "s_suppkey").select("id", "ra", "dec")
    c = positions(spark, sf_dir, "customer", "c_custkey").select(F.col("id").alias("rid"), "ra", "dec")
    return spatial.claimed(t, c, CLAIM).withColumnRenamed("id", "source")


@query("features_labels_join", "select d.doc_id as id, n_chars, quality, toxic from documents d join labels l using (doc_id)")
def features_labels_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    return curation.features_with_labels(d, table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id"), most_lost=0.1)


@query("training_upsert", "with a as (select c_custkey as id, c_name as obj_id, c_acctbal as v from customer where c_custkey % 3 <> 0), b as (select c_custkey as id, 'new_' || c_name as obj_id, c_acctbal * 2 as v from customer where c_custkey % 2 = 0) select coalesce(a.id, b.id) as id, coalesce(a.obj_id, b.obj_id) as obj_id, coalesce(b.v, a.v) as v from a full join b using (id)")
def training_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    old = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("obj_id"), F.col("c_acctbal").alias("v"))
    new = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("new_"), "c_name").alias("obj_id"), (F.col("c_acctbal") * 2).alias("v"))
    return curation.upsert(old, new)


@query("chunk_merge_dedup", "select id, x, case when src = 0 then null else y end as y from (select *, row_number() over (partition by id order by src) as n from (select c_custkey as id, c_acctbal as x, null::double as y, 0 as src from customer where c_custkey % 2 = 0 union all select c_custkey, c_acctbal, c_acctbal + 1, 1 from customer where c_custkey % 3 = 0)) where n = 1")
def chunk_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"))
    return curation.merge_chunks([c.filter("id % 2 = 0"), c.filter("id % 3 = 0").withColumn("y", F.col("x") + 1)], "id", ["x"])


@query("keep_unique", "select o_custkey as id, max(o_orderkey) as order_id from orders group by 1 having count(*) = 1")
def keep_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.keep_unique(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("order_id")), "id")


@query("duplicate_ids", "select count(*) - count(distinct o_custkey) as duplicates from orders")
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.duplicates(table(spark, sf_dir, "orders"), "o_custkey")


@query("pending_ids", "select c_custkey as id from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 7 = 0)")
def pending_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").filter("o_orderkey % 7 = 0").select(F.col("o_custkey").alias("id"))
    return curation.pending(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), done, "id")


@query("chunk_numbers", "select c_custkey as id, (row_number() over (order by c_custkey) - 1) // 100 as chunk from customer")
def chunk_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.chunk_numbers(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), ["id"], 100).select("id", "chunk")


@query("completeness", "select coalesce(field, -1) as field, coalesce(ccd, -1) as ccd, coalesce(quad, -1) as quad, count(*) as n from (select o_custkey % 3 as field, o_orderkey % 4 as ccd, (o_orderkey // 4) % 4 as quad, o_orderkey % 50 as nobs from orders) where nobs >= 20 group by rollup (field, ccd, quad)")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.completeness(quadrants(spark, sf_dir), 20).na.fill(-1, ["field", "ccd", "quad"])


def quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select((F.col("o_custkey") % 3).alias("field"), (k % 4).alias("ccd"), (F.floor(k / 4) % 4).alias("quad"), (k % 50).alias("nobs"))


@query("missing_quadrants", "select field, quads from (select field, count(distinct (ccd, quad)) as quads from (select o_custkey % 3 as field, o_orderkey % 4 as ccd, (o_orderkey // 4) % 4 as quad from orders) group by field) where quads < 64")
def missing_quadrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.missing_quadrants(quadrants(spark, sf_dir))


@query("field_totals", "select o_custkey % 3 as field, count(*) as n from orders where o_orderkey % 50 >= 20 group by 1")
def field_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.completeness(quadrants(spark, sf_dir), 20).filter("field is not null and ccd is null").select("field", "n")


@query("taxonomy_edges", "select r_name as parent, n_name as child from nation join region on n_regionkey = r_regionkey union all select 'world', r_name from region union all select null, 'world'")
def taxonomy_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name").collect()
    tree = {"class": "world", "subclasses": [{"class": r, "subclasses": [{"class": x["n_name"]} for x in rows if x["r_name"] == r]} for r in sorted({x["r_name"] for x in rows})]}
    return spark.createDataFrame(curation.taxonomy_edges(tree), "parent string, child string")


@query("probability_threshold", f"with {PREDICTIONS} select _id as id, 'variable' as class, vnv_dnn as probability from p where vnv_dnn >= 0.7 union all select _id, 'periodic', pnp_dnn from p where pnp_dnn >= 0.7")
def probability_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predictions(spark, sf_dir).withColumnRenamed("_id", "id")
    return curation.above_threshold(p, {"vnv_dnn": "variable", "pnp_dnn": "periodic", "vnv_xgb": "None"}, 0.7)


@query("drop_low_probs", f"with {PREDICTIONS} select _id, case when vnv_dnn < 0.5 then 0 else vnv_dnn end as vnv_dnn, case when pnp_dnn < 0.5 then 0 else pnp_dnn end as pnp_dnn from p")
def drop_low_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.zero_below(predictions(spark, sf_dir).select("_id", "vnv_dnn", "pnp_dnn"), ["vnv_dnn", "pnp_dnn"], 0.5)


@query("fields_setops", "select n_nationkey as field from nation where n_nationkey in (select c_nationkey from customer) union select s_nationkey from supplier except select n_nationkey from nation where n_regionkey = 0")
def fields_setops(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    seen = n.select(F.col("n_nationkey").alias("field")).intersect(table(spark, sf_dir, "customer").select("c_nationkey"))
    every = seen.union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()
    return every.exceptAll(n.filter("n_regionkey = 0").select("n_nationkey"))


@query("label_columns", "select unnest(['first', 'quarter']) as column")
def label_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_tax"), F.col("l_discount"), (F.col("l_linenumber") == 1).cast("double").alias("first"), F.when(F.col("l_linenumber") < 3, 0.25).otherwise(1.0).alias("quarter"))
    return spark.createDataFrame([(c,) for c in curation.label_columns(x)], "column string")
