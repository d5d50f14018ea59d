"""The funnel's operators as queries over the driver's tables, each beside its DuckDB SQL.

Molecules are stood in for: a lineitem is a pose (score -extendedprice, null for returnflag N;
distance = quantity), an order is a compound (score -totalprice), a custkey a cluster, an embedding's
signs a fingerprint and its label a scaffold group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievespark.functions import scalar as S
from sievespark.operators import cluster_stats as C
from sievespark.operators import clustering as B
from sievespark.operators import curves as V
from sievespark.operators import lookups as L
from sievespark.operators import ranking as R
from sievespark.operators import receptor as P
from sievespark.operators import rescoring as X
from sievespark.operators import similarity as T
from sievespark.operators.quantiles import quantiles
from sievespark.session import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---- Winners, ranks, cuts, dedup -------------------------------------------------------------


def poses(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("compound_id"), F.col("l_linenumber").alias("pose_idx"), "l_partkey", "l_suppkey", F.col("l_quantity").alias("distance"), F.when(F.col("l_returnflag") != "N", -F.col("l_extendedprice")).alias("score"))


def winners(spark: SparkSession, sf: str) -> DataFrame:
    near = poses(spark, sf).where("distance is not null and distance <= 5.0")
    return R.best_pose(near, ["compound_id"], "score", "distance", ["pose_idx", "l_partkey", "l_suppkey"])


def compounds(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("compound_id"), F.col("o_custkey").alias("cluster_id"), F.col("o_orderpriority").alias("conformation"), F.col("o_orderstatus").alias("status"), (-F.col("o_totalprice")).alias("ad4_score"))


POSES = """poses as (select l_orderkey as compound_id, l_linenumber as pose_idx, l_partkey, l_suppkey, l_quantity as distance,
  case when l_returnflag <> 'N' then -l_extendedprice end as score from lineitem)"""
WINNERS = f"""{POSES}, winners as (select * from poses where distance <= 5.0
  qualify row_number() over (partition by compound_id order by score is null, coalesce(score, distance), pose_idx, l_partkey, l_suppkey) = 1)"""
COMPOUNDS = """compounds as (select o_orderkey as compound_id, o_custkey as cluster_id, o_orderpriority as conformation,
  o_orderstatus as status, -o_totalprice as ad4_score from orders)"""


@query(f"with {WINNERS} select compound_id, pose_idx, distance, score from winners")
def winner_pose(spark: SparkSession, sf: str) -> DataFrame:
    return winners(spark, sf).select("compound_id", "pose_idx", "distance", "score")


@query("""with p as (select o_orderkey, count(l_orderkey) as n, count(*) filter (l_returnflag = 'R') as charged,
    count(*) filter (l_returnflag = 'R' and l_quantity <= 5) as near
  from orders left join lineitem on o_orderkey = l_orderkey group by o_orderkey)
select case when n = 0 then 'empty' when charged = 0 then 'no_charged_atom' when near = 0 then 'too_far' else 'passed' end as reason,
  count(*) as n from p group by 1""")
def fail_reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    li, o = read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders").select("o_orderkey")
    charged = F.col("l_returnflag") == "R"
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(charged).alias("charged"), F.count_if(charged & (F.col("l_quantity") <= 5)).alias("near"))
    all_ = o.join(per, o["o_orderkey"] == per["l_orderkey"], "left")
    reason = F.when(F.col("n").isNull(), "empty").when(F.col("charged") == 0, "no_charged_atom").when(F.col("near") == 0, "too_far").otherwise("passed")
    return all_.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"with {WINNERS} select compound_id, score, row_number() over (order by score, compound_id) as rank from winners where score is not null")
def ranked_hits(spark: SparkSession, sf: str) -> DataFrame:
    return R.ranked(winners(spark, sf).where("score is not null").select("compound_id", "score"), ["score", "compound_id"])


@query(f"with {COMPOUNDS} select conformation, compound_id, ad4_score, row_number() over (partition by conformation order by ad4_score, compound_id) as rank from compounds where ad4_score <= -300000.0")
def score_cutoff_prefix(spark: SparkSession, sf: str) -> DataFrame:
    kept = R.cut_prefix(compounds(spark, sf), "ad4_score", -300000.0)
    return R.ranked(kept.select("conformation", "compound_id", "ad4_score"), ["ad4_score", "compound_id"], ["conformation"])


@query("""select user_id, count(*) filter (bad) as inversions from (
  select user_id, lag(value) over (partition by user_id order by event_id) > value as bad from events) group by user_id""")
def sortedness_guard(spark: SparkSession, sf: str) -> DataFrame:
    return R.inversions(read_table(spark, sf, "events"), "event_id", "value", ["user_id"])


PARTS = """parts as (select concat(p_name, '_S', p_size, '_T', p_partkey % 3) as compound_id, p_retailprice as score, p_partkey from part),
based as (select *, regexp_replace(compound_id, '^(.*)_S\\d+_T\\d+$', '\\1') as base_id from parts)"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    name = F.concat("p_name", F.lit("_S"), "p_size", F.lit("_T"), F.col("p_partkey") % 3)
    return p.select(name.alias("compound_id"), F.col("p_retailprice").alias("score"), "p_partkey").withColumn("base_id", S.base_id(F.col("compound_id")))


@query(f"""with {PARTS} select base_id, compound_id, score, row_number() over (order by score, p_partkey) as rank
from (select * from based qualify row_number() over (partition by base_id order by score, p_partkey) = 1)""")
def dedup_base_id(spark: SparkSession, sf: str) -> DataFrame:
    best = R.best_per_key(parts(spark, sf), ["base_id"], [F.col("score"), F.col("p_partkey")])
    return R.ranked(best, ["score", "p_partkey"]).drop("p_partkey")


@query(f"""with {PARTS} select count(*) as n_in, count(distinct base_id) as n_out, count(*) - count(distinct base_id) as n_redundant,
  round(100.0 * (count(*) - count(distinct base_id)) / count(*), 6) as pct_redundant from based""")
def dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    sums = parts(spark, sf).agg(F.count(F.lit(1)).alias("n_in"), F.countDistinct("base_id").alias("n_out"))
    gone = F.col("n_in") - F.col("n_out")
    return sums.select("n_in", "n_out", gone.alias("n_redundant"), r6(100.0 * gone / F.col("n_in")).alias("pct_redundant"))


# ---- Lookups ---------------------------------------------------------------------------------


@query(f"""with {WINNERS}, {COMPOUNDS}
select c.compound_id, w.score, k.c_name as path, coalesce(r.pose_idx, 0) as pose_idx
from compounds c join winners w on w.compound_id = c.compound_id and w.score is not null
join customer k on k.c_custkey = c.cluster_id
left join (select compound_id, pose_idx from winners where pose_idx > 1) r on r.compound_id = c.compound_id
where c.status = 'F'""")
def survivor_join_4way(spark: SparkSession, sf: str) -> DataFrame:
    won = winners(spark, sf)
    passed = compounds(spark, sf).where("status = 'F'").select("compound_id", F.col("cluster_id").alias("c_custkey"))
    both = passed.join(won.where("score is not null").select("compound_id", "score"), "compound_id")
    paths = both.join(read_table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("path")), "c_custkey")
    out = L.with_default(paths, won.where("pose_idx > 1").select("compound_id", "pose_idx"), ["compound_id"], {"pose_idx": 0})
    return out.select("compound_id", "score", "path", "pose_idx")


@query("select o_orderkey, o_totalprice from orders where o_custkey in (select c_custkey from customer where c_acctbal > 5000)")
def semi_join_paths(spark: SparkSession, sf: str) -> DataFrame:
    rich = read_table(spark, sf, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return L.only_keys(read_table(spark, sf, "orders"), rich, ["o_custkey"]).select("o_orderkey", "o_totalprice")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def anti_join_missing(spark: SparkSession, sf: str) -> DataFrame:
    found = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return L.missing_keys(read_table(spark, sf, "orders"), found, ["o_orderkey"])


@query(f"with {WINNERS} select o_orderkey as compound_id, coalesce(pose_idx, 0) as pose_idx from orders left join winners on compound_id = o_orderkey")
def left_default_index(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("compound_id"))
    return L.with_default(o, winners(spark, sf).select("compound_id", "pose_idx"), ["compound_id"], {"pose_idx": 0})


@query("""select n_name, s_name, s_acctbal from nation join (
  select * from supplier qualify row_number() over (partition by s_nationkey order by s_suppkey desc) = 1) on s_nationkey = n_nationkey""")
def lookup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    last = R.last_wins(read_table(spark, sf, "supplier"), ["s_nationkey"], ["s_suppkey"])
    n = read_table(spark, sf, "nation")
    return n.join(last, n["n_nationkey"] == last["s_nationkey"]).select("n_name", "s_name", "s_acctbal")


@query("select c_custkey from customer where c_acctbal > 0 union select o_custkey from orders where o_totalprice > 400000")
def union_needed_ids(spark: SparkSession, sf: str) -> DataFrame:
    a = read_table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey")
    return a.union(read_table(spark, sf, "orders").where("o_totalprice > 400000").select("o_custkey")).distinct()


@query("""select 'customer' as source, c_nationkey as nationkey, count(*) as n from customer group by all
union all select 'supplier', s_nationkey, count(*) from supplier group by all""")
def union_all_tagged(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer").groupBy(F.lit("customer").alias("source"), F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    s = read_table(spark, sf, "supplier").groupBy(F.lit("supplier").alias("source"), F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return c.unionByName(s)


# ---- Reports ---------------------------------------------------------------------------------


@query("select " + ", ".join(f"min({c}) as min_{n}, max({c}) as max_{n}, round(avg({c}), 6) as mean_{n}, median({c}) as median_{n}" for c, n in (("l_extendedprice", "score"), ("l_quantity", "total"), ("l_discount", "single"))) + " from lineitem")
def score_range_report(spark: SparkSession, sf: str) -> DataFrame:
    cols = {"l_extendedprice": "score", "l_quantity": "total", "l_discount": "single"}
    li = read_table(spark, sf, "lineitem")
    ends = li.agg(*[x for c, n in cols.items() for x in (F.min(c).alias(f"min_{n}"), F.max(c).alias(f"max_{n}"), r6(F.avg(c)).alias(f"mean_{n}"))])
    middle = quantiles(li, list(cols), [0.5]).agg(*[F.max(F.when(F.col("of") == c, F.col("value"))).alias(f"median_{n}") for c, n in cols.items()])
    return ends.crossJoin(F.broadcast(middle))  # a row each


@query(f"""with {COMPOUNDS}, r as (select compound_id, row_number() over (order by ad4_score, compound_id) as rank from compounds)
select part, count(*) as n, min(rank) as first_rank, max(rank) as last_rank from (select rank, (rank - 1) // 500 as part from r) group by part""")
def part_file_number(spark: SparkSession, sf: str) -> DataFrame:
    placed = R.ranked(compounds(spark, sf).select("compound_id", "ad4_score"), ["ad4_score", "compound_id"])
    return placed.groupBy(S.chunk_index(F.col("rank"), 500).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"))


@query(f"with {COMPOUNDS} select compound_id, ad4_score from compounds order by ad4_score, compound_id limit 100")
def top_n_review(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_n(compounds(spark, sf).select("compound_id", "ad4_score"), 100, [F.col("ad4_score"), F.col("compound_id")])


@query("""with s as (select p_partkey, case when p_size % 7 = 0 then null when p_size % 5 = 0 then '' else p_type end as scaffold from part),
g as (select coalesce(scaffold, '__ERROR__' || p_partkey) as scaffold_key, count(*) as size, min(p_partkey) as first from s group by 1)
select scaffold_key, size, row_number() over (order by size desc, first) - 1 as bm_group_id from g""")
def bm_groups(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    scaffold = F.when(F.col("p_size") % 7 == 0, None).when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_type"))
    key = F.coalesce(scaffold, F.concat(F.lit("__ERROR__"), "p_partkey"))
    g = p.groupBy(key.alias("scaffold_key")).agg(F.count(F.lit(1)).alias("size"), F.min("p_partkey").alias("first"))
    placed = R.ranked(g.withColumn("less", -F.col("size")), ["less", "first"])
    return placed.select("scaffold_key", "size", (F.col("rank") - 1).alias("bm_group_id"))


@query("""with g as (select c_mktsegment, c_nationkey, count(*) as size from customer group by all)
select c_mktsegment, count(*) as n_groups, count(*) filter (size >= 10) as n_large, max(size) as largest from g group by 1""")
def group_size_report(spark: SparkSession, sf: str) -> DataFrame:
    g = read_table(spark, sf, "customer").groupBy("c_mktsegment", "c_nationkey").count()
    return g.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("count") >= 10).alias("n_large"), F.max("count").alias("largest"))


# ---- Similarity and clustering ---------------------------------------------------------------

GRID = tuple(range(4, 13))  # thresholds of 0.20 to 0.60, in twentieths


def fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select(F.col("label").alias("group"), F.col("vec_id").alias("node"), T.sign_bits(F.col("embedding")).alias("fp"))


FP = """fp as (select label as grp, vec_id as node, embedding as v from embeddings),
pairs as (select a.grp, a.node as a, b.node as b,
    cast(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] > 0 and b.v[i] > 0)::int)) as bigint) as inter,
    cast(list_sum(list_transform(range(1, 65), lambda i: (a.v[i] > 0 or b.v[i] > 0)::int)) as bigint) as uni
  from fp a join fp b on a.grp = b.grp and a.node < b.node),
edges as (select * from pairs where inter * 20 >= uni * 4)"""
DEGREES = f"""{FP}, grid as (select grp, node, k from fp, (select unnest(range(4, 13)) as k)),
links as (select grp, k, a as x, b as y from edges, (select unnest(range(4, 13)) as k) where inter * 20 >= uni * k),
sym as (select grp, k, x, y from links union all select grp, k, y, x from links),
degree as (select g.grp, g.k, g.node, count(s.y) as degree, list(s.y) filter (s.y is not null) as near from grid g left join sym s on s.grp = g.grp and s.k = g.k and s.x = g.node group by all)"""
BUTINA = f"""{DEGREES}, placed as (select *, row_number() over (partition by grp, k order by degree desc, node) as pos from degree),
walk as (
  select grp, k, cast(0 as bigint) as pos, cast([] as bigint[]) as cents from placed group by grp, k
  union all
  select w.grp, w.k, p.pos, case when list_has_any(coalesce(p.near, []), w.cents) then w.cents else list_append(w.cents, p.node) end
  from walk w join placed p on p.grp = w.grp and p.k = w.k and p.pos = w.pos + 1
), last as (select grp, k, arg_max(cents, pos) as cents from walk group by grp, k),
butina as (select p.grp, p.k, p.node, case when list_contains(l.cents, p.node) then p.node else
    (select arg_min(q.node, q.pos) from placed q where q.grp = p.grp and q.k = p.k and list_contains(l.cents, q.node) and list_contains(p.near, q.node)) end as centroid
  from placed p join last l on l.grp = p.grp and l.k = p.k)"""


@query(f"with {FP} select grp, a, b, inter, uni, round(inter / uni, 6) as tc from edges where inter * 20 >= uni * 6")
def tanimoto_edges(spark: SparkSession, sf: str) -> DataFrame:
    e = T.edges(fingerprints(spark, sf), "group", "node", "fp", 6)
    tc = F.expr("(2000000L * inter + uni) div (2 * uni)") / 1e6  # as round() gives it for up to 64 bits, without a decimal a row
    return e.select(big("group").alias("grp").cast("int"), "a", "b", big("inter").alias("inter"), big("uni").alias("uni"), tc.alias("tc"))


@query(f"with {DEGREES} select grp, k, node, degree from degree")
def degree_per_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return B.degrees_of_fingerprints(fingerprints(spark, sf), GRID).select(F.col("group").alias("grp"), big("k").alias("k"), "node", big("degree").alias("degree"))


@query(f"with recursive {BUTINA} select grp, k, node, centroid from butina")
def butina_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return B.butina_of_fingerprints(fingerprints(spark, sf), GRID).select(F.col("group").alias("grp"), big("k").alias("k"), "node", "centroid")


@query(f"with recursive {BUTINA} select grp, k, node, centroid from butina")
def butina_by_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return B.butina_of_fingerprints(fingerprints(spark, sf), GRID, first=16).select(F.col("group").alias("grp"), big("k").alias("k"), "node", "centroid")


NESTED = f"""{BUTINA}, sizes as (select grp, count(*) as size, min(node) as first from fp group by grp),
nested as (select b.grp, b.k, b.node, case when s.size < 50 then s.first else b.centroid end as centroid from butina b join sizes s using (grp))"""


def nested_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return B.nested_of_fingerprints(fingerprints(spark, sf), GRID, least=50)


@query(f"with recursive {NESTED} select grp, k, node, centroid from nested")
def nested_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return nested_clusters(spark, sf).select(F.col("group").alias("grp"), big("k").alias("k"), "node", "centroid")


@query(f"""with recursive {NESTED}, firsts as (select k, grp, centroid, min(node) as first from nested group by all),
groups as (select k, grp, count(*) >= 50 as large, min(node) as start from nested group by all),
ids as (select f.k, f.grp, f.centroid, row_number() over (partition by f.k order by large, start, first) - 1 as cluster_id from firsts f join groups using (k, grp))
select grp, k, node, cluster_id from nested join ids using (k, grp, centroid)""")
def global_cluster_ids(spark: SparkSession, sf: str) -> DataFrame:
    return B.numbered(nested_clusters(spark, sf), 50).select(F.col("group").alias("grp"), big("k").alias("k"), "node", "cluster_id")


SUMMARY = f"""{NESTED}, csize as (select k, grp, centroid, count(*) as size from nested group by all),
ordered as (select *, row_number() over (partition by k order by size desc, grp, centroid) as place from csize),
summary as (select k, cast(sum(size) as bigint) as n_compounds, count(*) as n_clusters, count(*) filter (size = 1) as n_singletons, max(size) as largest_cluster_size,
  round(avg(size), 6) as mean_cluster_size, median(size) as median_cluster_size,
  100.0 * sum(case when place <= 10 then size else 0 end)::double / sum(size)::double as top10_raw from ordered group by k)"""


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return B.size_summary(nested_clusters(spark, sf), ["k"], ["group", "centroid"])


@query(f"with recursive {SUMMARY} select k, n_compounds, n_clusters, n_singletons, largest_cluster_size, mean_cluster_size, median_cluster_size, round(top10_raw, 6) as top10_pct from summary")
def cluster_size_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = summary(spark, sf)
    return s.select(big("k").alias("k"), big("n_compounds").alias("n_compounds"), "n_clusters", "n_singletons", big("largest_cluster_size").alias("largest_cluster_size"), r6("mean_cluster_size").alias("mean_cluster_size"), "median_cluster_size", r6("top10_pct").alias("top10_pct"))


# Curves over a grid: shares of lineitems below a quantity, per return flag.
CURVE = """curve as (select l_returnflag as conformation, cast(k as double) / 20 as tc, cast(count(*) filter (l_quantity <= 50.0 * k * k / 144) as double) as y
  from lineitem, (select unnest(range(1, 13)) as k) group by all),
slope1 as (select conformation, tc as low, lead(tc) over w as high, y as y0, lead(y) over w as y1 from curve window w as (partition by conformation order by tc)),
s1 as (select conformation, low, high, (low + high) / 2 as mid, (y1 - y0) / (high - low) as slope from slope1 where high is not null)"""


def curve(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem").groupBy("l_returnflag", "l_quantity").count()  # a few rows: the grid meets counts, not lines
    grid = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("k")
    rows = li.select(F.col("l_returnflag").alias("conformation"), "l_quantity", "count", grid)
    return rows.groupBy("conformation", (F.col("k").cast("double") / 20).alias("tc")).agg(F.sum(F.when(F.col("l_quantity") <= 50.0 * F.col("k") * F.col("k") / 144, F.col("count")).otherwise(0)).cast("double").alias("y"))


@query(f"with {CURVE} select conformation, round(low, 6) as low, round(high, 6) as high, round(mid, 6) as mid, round(slope, 4) as slope from s1")
def curve_slope1(spark: SparkSession, sf: str) -> DataFrame:
    s = V.slopes(curve(spark, sf), "tc", "y", ["conformation"])
    return s.select("conformation", *[r6(c).alias(c) for c in ("low", "high", "mid")], F.round("slope", 4).alias("slope"))


@query(f"""with {CURVE}, s2 as (select conformation, mid as low, lead(mid) over w as high, slope as y0, lead(slope) over w as y1 from s1 window w as (partition by conformation order by mid))
select conformation, round(low, 6) as low, round(high, 6) as high, round((y1 - y0) / (high - low), 2) as slope2 from s2 where high is not null""")
def curve_slope2(spark: SparkSession, sf: str) -> DataFrame:
    s = V.slopes(V.slopes(curve(spark, sf), "tc", "y", ["conformation"]), "mid", "slope", ["conformation"])
    return s.select("conformation", r6("low").alias("low"), r6("high").alias("high"), F.round("slope", 2).alias("slope2"))


UPPER = f"""{CURVE}, upper_ as (select conformation, coalesce(max(mid) filter (slope >= 0.5 * peak), max(mid)) as upper
  from (select *, max(slope) over (partition by conformation) as peak from s1) group by 1)"""
LOWER = f"""lower_ as (select conformation, coalesce(min(mid) filter (-slope < before and -slope < after), min(mid)) as lower
  from (select *, lag(-slope) over w as before, lead(-slope) over w as after from s1 window w as (partition by conformation order by mid)) group by 1)"""


@query(f"with {UPPER} select conformation, round(upper, 6) as upper from upper_")
def upper_bound_halfmax(spark: SparkSession, sf: str) -> DataFrame:
    s = V.half_maximum(V.slopes(curve(spark, sf), "tc", "y", ["conformation"]), ["conformation"])
    return s.select("conformation", r6("upper").alias("upper"))


@query(f"with {CURVE}, {LOWER} select conformation, round(lower, 6) as lower from lower_")
def lower_bound_localmin(spark: SparkSession, sf: str) -> DataFrame:
    s = V.local_minimum(V.slopes(curve(spark, sf), "tc", "y", ["conformation"]), ["conformation"])
    return s.select("conformation", r6("lower").alias("lower"))


def bounds(spark: SparkSession, sf: str) -> DataFrame:
    s = V.slopes(curve(spark, sf), "tc", "y", ["conformation"])
    return V.intersection(V.half_maximum(s, ["conformation"]).join(V.local_minimum(s, ["conformation"]), "conformation"), [k / 20 for k in range(1, 13)])


SNAPPED = f"""{UPPER}, {LOWER}, ends as (select max(lower) as lo, min(upper) as hi from upper_ join lower_ using (conformation)),
grid as (select cast(k as double) / 20 as g from (select unnest(range(1, 13)) as k)),
snapped as (select (select g from grid order by abs(g - lo), g desc limit 1) as a, (select g from grid order by abs(g - hi), g desc limit 1) as b, lo, hi from ends),
rng as (select lo, hi, least(a, b) as lower, greatest(a, b) as upper from snapped)"""


@query(f"with {SNAPPED} select round(lo, 6) as lo, round(hi, 6) as hi, round(lower, 6) as lower, round(upper, 6) as upper from rng")
def tc_range_combined(spark: SparkSession, sf: str) -> DataFrame:
    return bounds(spark, sf).select(*[r6(c).alias(c) for c in ("lo", "hi", "lower", "upper")])


@query(f"with {SNAPPED} select conformation, round(tc, 6) as tc, cast(y as bigint) as n_clusters from curve, rng where tc between lower and upper")
def cluster_counts_in_range(spark: SparkSession, sf: str) -> DataFrame:
    inside = curve(spark, sf).join(F.broadcast(bounds(spark, sf).select("lower", "upper")), F.col("tc").between(F.col("lower"), F.col("upper")))
    return inside.select("conformation", r6("tc").alias("tc"), big("y").alias("n_clusters"))


@query(f"with {SNAPPED} select conformation, round(tc, 6) as tc, cast(y as bigint) as n_clusters, tc between lower and upper as inside, round(lo, 6) as lo, round(hi, 6) as hi from curve, rng")
def curves_with_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Whole curves, with which of their points lie in the common range and where its ends are."""
    both = curve(spark, sf).crossJoin(F.broadcast(bounds(spark, sf)))  # one row of bounds
    return both.select("conformation", r6("tc").alias("tc"), big("y").alias("n_clusters"), F.col("tc").between(F.col("lower"), F.col("upper")).alias("inside"), r6("lo").alias("lo"), r6("hi").alias("hi"))


# ---- Statistics of clusters ------------------------------------------------------------------

ZSCORES = f"""{COMPOUNDS}, zs as (select *, (ad4_score - avg(ad4_score) over w) / stddev_pop(ad4_score) over w as z from compounds window w as (partition by conformation))"""
STATS = f"""{ZSCORES}, stats as (select conformation, cluster_id, count(*) as count, avg(z) as mean_z, min(z) as min_z, coalesce(stddev_samp(z), 0) as std_z from zs group by all),
q3 as (select *, count >= 2 and std_z < 1.0 as trustworthy from stats)"""
GOOD = f"""{STATS}, q4 as (select *, cast(format('{{:.4f}}', mean_z) as double) * sqrt(count) as t_stat, cast(format('{{:.4f}}', mean_z) as double) * sqrt(count) <= {S.GOOD_T} as good from q3 where trustworthy)"""


def zscores(spark: SparkSession, sf: str) -> DataFrame:
    return C.pool_zscore(compounds(spark, sf), "ad4_score", ["conformation"])


def q3(spark: SparkSession, sf: str) -> DataFrame:
    return C.describe_clusters(zscores(spark, sf), ["conformation", "cluster_id"])


def q4(spark: SparkSession, sf: str) -> DataFrame:
    return C.judge_clusters(q3(spark, sf))


@query(f"with {ZSCORES} select conformation, compound_id, ad4_score, round(z, 6) as z from zs")
def pool_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return zscores(spark, sf).select("conformation", "compound_id", "ad4_score", r6("z").alias("z"))


@query(f"with {STATS} select conformation, cluster_id, count, round(mean_z, 6) as mean_z, round(min_z, 6) as min_z, round(std_z, 6) as std_z, trustworthy from q3")
def cluster_stats_q3(spark: SparkSession, sf: str) -> DataFrame:
    return q3(spark, sf).select("conformation", "cluster_id", "count", *[r6(c).alias(c) for c in ("mean_z", "min_z", "std_z")], "trustworthy")


Q3SUM = """q3s as (select conformation, count(*) as n_clusters_total, count(*) filter (count = 1) as n_singleton, count(*) filter (count >= 2) as n_testable,
  count(*) filter (trustworthy) as n_trustworthy from q3 group by 1)"""


def q3_sums(spark: SparkSession, sf: str) -> DataFrame:
    return q3(spark, sf).groupBy("conformation").agg(F.count(F.lit(1)).alias("n_clusters_total"), F.count_if(F.col("count") == 1).alias("n_singleton"), F.count_if(F.col("count") >= 2).alias("n_testable"), F.count_if("trustworthy").alias("n_trustworthy"))


@query(f"with {STATS}, {Q3SUM} select *, round(100.0 * n_trustworthy / greatest(1, n_testable), 6) as pct from q3s")
def q3_summary(spark: SparkSession, sf: str) -> DataFrame:
    return q3_sums(spark, sf).withColumn("pct", r6(C.percent(F.col("n_trustworthy"), F.col("n_testable"))))


@query(f"with {GOOD} select conformation, cluster_id, count, round(t_stat, 6) as t_stat, good from q4")
def good_clusters_q4(spark: SparkSession, sf: str) -> DataFrame:
    return q4(spark, sf).select("conformation", "cluster_id", "count", r6("t_stat").alias("t_stat"), "good")


def horner(*coefficients: float) -> str:
    out = "0.0"
    for c in coefficients:
        out = f"({out} * a + {c!r}::double)"
    return out


CDF = f"""exp(-a * a / 2) * case when a < 7.07106781186547 then
  {horner(3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)}
  / {horner(8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)}
  else 1 / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / 2.506628274631 end"""


@query(f"""with {GOOD}, x as (select conformation, cluster_id, t_stat, abs(t_stat) as a from q4), y as (select *, {CDF} as tail from x)
select conformation, cluster_id, round(t_stat, 6) as t_stat, round(case when t_stat > 0 then 1 - tail else tail end, 9) as p_value from y""")
def p_values_q4(spark: SparkSession, sf: str) -> DataFrame:
    return C.p_values(q4(spark, sf)).select("conformation", "cluster_id", r6("t_stat").alias("t_stat"), F.round("p_value", 9).alias("p_value"))


Q4SUM = "q4s as (select conformation, count(*) as n_tested, count(*) filter (good) as n_good from q4 group by 1)"


def q4_sums(spark: SparkSession, sf: str) -> DataFrame:
    return q4(spark, sf).groupBy("conformation").agg(F.count(F.lit(1)).alias("n_tested"), F.count_if("good").alias("n_good"))


@query(f"with {GOOD}, {Q4SUM} select *, round(100.0 * n_good / greatest(1, n_tested), 6) as pct_good from q4s")
def q4_summary(spark: SparkSession, sf: str) -> DataFrame:
    return q4_sums(spark, sf).withColumn("pct_good", r6(C.percent(F.col("n_good"), F.col("n_tested"))))


@query(f"""with {GOOD}, {Q3SUM}, {Q4SUM} select conformation, n_clusters_total as n_full, n_testable as n_non_singleton, n_trustworthy as trustworthy,
  coalesce(n_good, 0) as good, n_trustworthy - coalesce(n_good, 0) as tier2 from q3s left join q4s using (conformation)""")
def tier_table(spark: SparkSession, sf: str) -> DataFrame:
    """All tiers in one pass over the clusters."""
    good = F.col("trustworthy") & F.col("good")
    tiers = C.t_statistics(q3(spark, sf)).groupBy("conformation").agg(F.count(F.lit(1)).alias("n_full"), F.count_if(F.col("count") >= 2).alias("n_non_singleton"), F.count_if("trustworthy").alias("trustworthy"), F.count_if(good).alias("good"))
    return tiers.withColumn("tier2", F.col("trustworthy") - F.col("good"))


OUTLIERS = "outliers as (select z.* from zs z join q3 q using (conformation, cluster_id) where q.count = 1 and z.z <= -1.5)"


def outliers(spark: SparkSession, sf: str, cut: float = -1.5) -> DataFrame:
    alone = q3(spark, sf).where("count = 1").select("conformation", "cluster_id")
    return zscores(spark, sf).join(alone, ["conformation", "cluster_id"], "left_semi").where(F.col("z") <= cut)


@query(f"with {STATS}, {OUTLIERS} select conformation, compound_id, ad4_score, round(z, 6) as z, row_number() over (partition by conformation order by ad4_score, compound_id) as place from outliers")
def singleton_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """In order of z within each conformation (that of the scores)."""
    placed = R.ranked(outliers(spark, sf).select("conformation", "compound_id", "ad4_score", "z"), ["ad4_score", "compound_id"], ["conformation"], "place")
    return placed.select("conformation", "compound_id", "ad4_score", r6("z").alias("z"), "place")


@query(f"""with recursive {BUTINA}, c as (select grp, node, centroid from butina where k = 6),
both_ as (select grp, a, b, inter / uni as sim from pairs union all select grp, b, a, inter / uni from pairs),
m as (select x.grp, x.centroid, x.node, avg(s.sim) as mean_sim from c x left join (both_ s join c y on y.node = s.b) on s.a = x.node and y.centroid = x.centroid and y.grp = x.grp group by all)
select grp, centroid, arg_min(node, (round(-coalesce(mean_sim, -1), 9), node)) as medoid from m group by all""")
def medoid_per_cluster(spark: SparkSession, sf: str) -> DataFrame:
    fp = fingerprints(spark, sf)
    clusters = B.butina_of_fingerprints(fp, (6,)).select("group", "node", "centroid")
    return T.cluster_medoids(clusters.join(fp, ["group", "node"]), ["group", "centroid"]).select(F.col("group").alias("grp"), "centroid", "medoid")


@query(f"with {COMPOUNDS} select conformation, cluster_id, compound_id as best_scorer from compounds qualify row_number() over (partition by conformation, cluster_id order by ad4_score, compound_id) = 1")
def best_scorer_per_cluster(spark: SparkSession, sf: str) -> DataFrame:
    c = compounds(spark, sf)
    return c.groupBy("conformation", "cluster_id").agg(F.min_by("compound_id", F.struct("ad4_score", "compound_id")).alias("best_scorer"))


PICKS = f"""{GOOD}, {OUTLIERS}, members as (select z.* from zs z join q4 g using (conformation, cluster_id) where g.good),
best as (select conformation, cluster_id, compound_id, ad4_score, 'best_scorer' as role from members qualify row_number() over (partition by conformation, cluster_id order by ad4_score, compound_id) = 1),
mid as (select m.conformation, m.cluster_id, m.compound_id, m.ad4_score, 'medoid' as role from members m join q4 g using (conformation, cluster_id)
  qualify row_number() over (partition by conformation, cluster_id order by round(abs(m.z - g.mean_z), 9), compound_id) = 1),
roles as (select conformation, cluster_id, compound_id, ad4_score, string_agg(role, '+' order by role) as roles from (select * from best union all select * from mid) group by all),
picks as (select r.conformation, 'cluster' as source, r.cluster_id, r.compound_id, r.ad4_score, g.count as cluster_size, r.roles from roles r join q4 g using (conformation, cluster_id)
  union all select conformation, 'singleton', cluster_id, compound_id, ad4_score, 1, 'singleton_outlier' from outliers)"""


def picks(spark: SparkSession, sf: str) -> DataFrame:
    from sievespark.operators.selection import pick_list

    good = q4(spark, sf).where("good")
    return pick_list(zscores(spark, sf), good, outliers(spark, sf), ["conformation", "cluster_id"])


@query(f"with {PICKS} select conformation, cluster_id, compound_id, roles from roles")
def role_merge(spark: SparkSession, sf: str) -> DataFrame:
    return picks(spark, sf).where("source = 'cluster'").select("conformation", "cluster_id", "compound_id", "roles")


@query(f"with {PICKS} select conformation, source, cluster_id, compound_id, ad4_score, cast(cluster_size as bigint) as cluster_size, roles from picks")
def pick_list_q5(spark: SparkSession, sf: str) -> DataFrame:
    return picks(spark, sf)


@query(f"""with {PICKS}, kept as (select distinct conformation, cluster_id from picks where source = 'cluster'),
x as (select g.*, abs(t_stat) as a from q4 g join kept using (conformation, cluster_id)), y as (select *, {CDF} as tail from x)
select conformation, cluster_id, count, round(mean_z, 6) as mean_z, round(min_z, 6) as min_z, round(std_z, 6) as std_z, round(t_stat, 6) as t_stat, round(case when t_stat > 0 then 1 - tail else tail end, 9) as p_value from y""")
def kept_clusters_q5(spark: SparkSession, sf: str) -> DataFrame:
    from sievespark.operators.selection import kept_clusters

    kept = kept_clusters(picks(spark, sf), q4(spark, sf), ["conformation", "cluster_id"])
    return kept.select("conformation", "cluster_id", "count", *[r6(c).alias(c) for c in ("mean_z", "min_z", "std_z", "t_stat")], F.round("p_value", 9).alias("p_value"))


@query(f"""with {PICKS} select conformation, count(*) filter (source = 'cluster') as cluster, count(*) filter (source = 'singleton') as singleton, count(*) as total from picks group by 1""")
def composition_pivot(spark: SparkSession, sf: str) -> DataFrame:
    p = picks(spark, sf).groupBy("conformation").pivot("source", ["cluster", "singleton"]).agg(F.count(F.lit(1)))
    filled = p.fillna(0, ["cluster", "singleton"])
    return filled.withColumn("total", F.col("cluster") + F.col("singleton"))


@query(f"with {ZSCORES} select conformation, cast(c as double) / 4 as cutoff, count(*) filter (z <= cast(c as double) / 4) as n from zs, (select unnest(range(-12, -3)) as c) group by all")
def cutoff_sweep(spark: SparkSession, sf: str) -> DataFrame:
    cuts = [c / 4 for c in range(-12, -3)]
    sums = zscores(spark, sf).groupBy("conformation").agg(*[F.count_if(F.col("z") <= c).alias(f"n{i}") for i, c in enumerate(cuts)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("cutoff"), F.col(f"n{i}").alias("n")) for i, c in enumerate(cuts)]))
    return sums.select("conformation", rows.alias("r")).select("conformation", "r.cutoff", "r.n")


@query(f"with {STATS} select conformation, cast(floor(std_z * 20) as bigint) as bin, trustworthy, count(*) as n from q3 where count >= 2 and std_z <= 2.0 group by all")
def stdz_histogram(spark: SparkSession, sf: str) -> DataFrame:
    kept = q3(spark, sf).where("count >= 2 and std_z <= 2.0")
    return kept.groupBy("conformation", F.floor(F.col("std_z") * 20).cast("long").alias("bin"), "trustworthy").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {STATS}, t as (select *, cast(format('{{:.4f}}', mean_z) as double) * sqrt(count) as t_stat from q3),
c as (select conformation, mean_z, case when count < 2 then 'singleton' when std_z >= 1.0 then 'loose' when t_stat <= {S.GOOD_T} then 'tier1' else 'tier2' end as category from t)
select conformation, category, count(*) as n, round(avg(mean_z), 6) as mean_of_means from c group by all""")
def category_means(spark: SparkSession, sf: str) -> DataFrame:
    named = q3(spark, sf).withColumn("category", S.tier(F.col("count"), F.col("std_z"), S.rounded(F.col("mean_z"), 4) * F.sqrt("count")))
    return named.groupBy("conformation", "category").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("mean_z")).alias("mean_of_means"))


@query(f"with {GOOD} select conformation, cluster_id, count, round(mean_z, 6) as mean_z, round(-1.645 / sqrt(count), 6) as boundary, good from q4")
def significance_scatter(spark: SparkSession, sf: str) -> DataFrame:
    return q4(spark, sf).select("conformation", "cluster_id", "count", r6("mean_z").alias("mean_z"), r6(-1.645 / F.sqrt("count")).alias("boundary"), "good")


@query(f"with {COMPOUNDS} select conformation, round(avg(ad4_score) - 3.0 * stddev_pop(ad4_score), 4) as raw_at_minus3 from compounds group by 1")
def z_to_raw(spark: SparkSession, sf: str) -> DataFrame:
    return compounds(spark, sf).groupBy("conformation").agg(F.round(F.avg("ad4_score") - 3.0 * F.stddev_pop("ad4_score"), 4).alias("raw_at_minus3"))


# ---- Rescoring, final lists ------------------------------------------------------------------

RESCORED = """rescored as (select l_orderkey as cluster_id, l_partkey as compound_id, l_suppkey, l_linenumber,
  case when l_linestatus = 'F' then -l_extendedprice * (1 - l_discount) end as dg, -l_quantity * 1000 - l_partkey as ad4 from lineitem)"""


def rescored(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("cluster_id"), F.col("l_partkey").alias("compound_id"), "l_suppkey", "l_linenumber", F.when(F.col("l_linestatus") == "F", -F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("dg"), (-F.col("l_quantity") * 1000 - F.col("l_partkey")).alias("ad4"))


@query(f"with {RESCORED} select dg is null as failed, count(*) as n, round(min(dg), 4) as best from rescored group by 1")
def rescoring_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = X.split_results(rescored(spark, sf).withColumnRenamed("dg", "mmgbsa_dg"))
    good, bad = (p.groupBy(F.lit(failed).alias("failed")).agg(F.count(F.lit(1)).alias("n"), F.round(F.min("mmgbsa_dg"), 4).alias("best")) for p, failed in zip(parts, (False, True)))
    return good.unionByName(bad)


@query(f"""with {RESCORED} select mmgbsa_rank, cluster_id, compound_id, round(dg, 4) as dg, ad4_rank from (
  select *, row_number() over (order by dg, cluster_id, compound_id, l_suppkey, l_linenumber) as mmgbsa_rank, row_number() over (order by ad4, cluster_id, compound_id, l_suppkey, l_linenumber) as ad4_rank
  from rescored where dg is not null) where mmgbsa_rank <= 20""")
def top20_vs_rank(spark: SparkSession, sf: str) -> DataFrame:
    tie = ["cluster_id", "compound_id", "l_suppkey", "l_linenumber"]
    done = rescored(spark, sf).where("dg is not null")
    both = R.ranked(R.ranked(done, ["dg", *tie], name="mmgbsa_rank"), ["ad4", *tie], name="ad4_rank")
    return both.where("mmgbsa_rank <= 20").select("mmgbsa_rank", "cluster_id", "compound_id", F.round("dg", 4).alias("dg"), "ad4_rank")


@query("""select event_id // 20 as chunk, count(*) as n, round(sum(value), 6) as total from events group by 1 having not bool_or(event_type = 'error')""")
def failed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """What stays when chunks with any error are dropped as a whole."""
    e = read_table(spark, sf, "events").select(F.expr("event_id div 20").alias("chunk"), "value", F.when(F.col("event_type") == "error", "failed").alias("error"))
    return X.drop_failed_chunks(e, "chunk").groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value")).alias("total"))


@query("select user_id, count(*) as done, count(*) filter (event_type = 'error') as failed, count(*) >= 20 and count(*) filter (event_type = 'error') > 0.3 * count(*) as alarm from events group by 1")
def failure_alarm(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("done"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return e.withColumn("alarm", (F.col("done") >= 20) & (F.col("failed") > 0.3 * F.col("done")))


@query("select distinct event_id // 20 as chunk from events where event_id // 20 not in (select event_id // 20 from events where event_type = 'purchase')")
def resume_todo(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events").select(F.expr("event_id div 20").alias("chunk"), "event_type")
    return L.missing_keys(e, e.where("event_type = 'purchase'"), ["chunk"])


@query(f"""with {RESCORED}, r as (select *, case when cluster_id % 10 = 0 then 'singleton' else 'cluster' end as source from rescored where dg is not null)
select cluster_id, compound_id, round(dg, 4) as dg, source from r where source = 'cluster' qualify row_number() over (partition by cluster_id order by dg, compound_id) = 1
union all select cluster_id, compound_id, round(dg, 4), source from r where source = 'singleton'""")
def best_per_cluster_rescored(spark: SparkSession, sf: str) -> DataFrame:
    """The best of each cluster; every tenth order stands for lone picks, which all pass."""
    done = rescored(spark, sf).where("dg is not null").withColumn("source", F.when(F.col("cluster_id") % 10 == 0, "singleton").otherwise("cluster"))
    return X.best_per_cluster(done, ["cluster_id"], "dg").select("cluster_id", "compound_id", F.round("dg", 4).alias("dg"), "source")


@query("""with q as (select vec_id, embedding as v from embeddings where label <> 0), k as (select embedding as w from embeddings where label = 0),
t as (select vec_id, max(list_sum(list_transform(range(1, 65), lambda i: (v[i] > 0 and w[i] > 0)::int)) / list_sum(list_transform(range(1, 65), lambda i: (v[i] > 0 or w[i] > 0)::int))) as max_tc from q, k group by 1)
select vec_id, round(max_tc, 6) as max_tc, case when max_tc >= 0.55 then 'known' when max_tc >= 0.35 then 'borderline' else 'novel' end as flag from t""")
def novelty_max_tc(spark: SparkSession, sf: str) -> DataFrame:
    """One label stands for the known actives, so both sides grow with the table."""
    fp = fingerprints(spark, sf)
    t = T.max_similarity(fp.where("group <> 0"), "node", "fp", fp.where("group = 0"), "fp")
    return t.select(F.col("node").alias("vec_id"), r6("max_tc").alias("max_tc"), F.when(F.col("max_tc") >= 0.55, "known").when(F.col("max_tc") >= 0.35, "borderline").otherwise("novel").alias("flag"))


@query(f"with {COMPOUNDS} select conformation, compound_id, rank, rank <= 30 as in_top30 from (select *, row_number() over (partition by conformation order by ad4_score, compound_id) as rank from compounds)")
def final_rank_top30(spark: SparkSession, sf: str) -> DataFrame:
    placed = R.ranked(compounds(spark, sf).select("conformation", "compound_id", "ad4_score"), ["ad4_score", "compound_id"], ["conformation"])
    return placed.select("conformation", "compound_id", "rank", (F.col("rank") <= 30).alias("in_top30"))


@query("""with r as (select c_custkey, row_number() over (order by -c_acctbal, c_custkey) as r1, row_number() over (order by c_nationkey, c_custkey) as r2 from customer)
select c_custkey, round(exp(-r1 / 100.0) / 100.0 + exp(-r2 / 100.0) / 100.0, 9) as consensus, (r1 + r2) / 2.0::double as mean_rank from r""")
def consensus_rank(spark: SparkSession, sf: str) -> DataFrame:
    from sievespark.operators.selection import consensus

    c = read_table(spark, sf, "customer").select("c_custkey", (-F.col("c_acctbal")).alias("a"), F.col("c_nationkey").alias("b"))
    both = R.ranked(R.ranked(c, ["a", "c_custkey"], name="r1"), ["b", "c_custkey"], name="r2")
    return consensus(both, ["r1", "r2"], sigma=100.0).select("c_custkey", F.round("consensus", 9).alias("consensus"), "mean_rank")


@query("select o_orderkey, o_totalprice from orders qualify row_number() over (order by -o_totalprice, o_orderkey) <= (select ceil(count(*) * 0.01) from orders)")
def top_percent(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("s"))
    return R.share_cut(o, 0.01, ["s", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("select p_partkey from part where p_size between 10 and 40 and p_retailprice between 950 and 1500 and p_brand <> 'Brand#11' and length(p_name) <= 30")
def prescreen_filter(spark: SparkSession, sf: str) -> DataFrame:
    from sievespark.operators.selection import within_ranges

    p = read_table(spark, sf, "part").withColumn("name_length", F.length("p_name"))
    return within_ranges(p, {"p_size": (10, 40), "p_retailprice": (950, 1500), "name_length": (None, 30)}).where("p_brand <> 'Brand#11'").select("p_partkey")


@query("select distinct l_partkey from lineitem where l_extendedprice <= 10000 and l_quantity <= 10")
def known_actives_filter(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").where("l_extendedprice <= 10000 and l_quantity <= 10").select("l_partkey").distinct()


@query("""with s as (select case when l_returnflag = 'N' then null else l_quantity / 5 end as total, l_discount * 25 as single, l_tax > 0.07 as flagged from lineitem)
select case when flagged or total is null then 'unscored' when total >= 7.0 or single >= 1.8 then 'strained' else 'passed' end as outcome, count(*) as n from s group by 1""")
def strain_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    s = S.strained(F.when(F.col("l_returnflag") != "N", F.col("l_quantity") / 5), F.col("l_discount") * 25, F.col("l_tax") > 0.07)
    return li.groupBy(F.when(s.isNull(), "unscored").when(s, "strained").otherwise("passed").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


# ---- Geometry and strain ---------------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(b0 + (b1 - b0) * (theta - edge) / 10.0, 6) as energy from (
  select *, (((36 + cast(ceil(theta / 10) as bigint) + 17) % 36) * 7 % 11)::double as b1, (((36 + cast(ceil(theta / 10) as bigint) + 17 + 35) % 36) * 7 % 11)::double as b0, (ceil(theta / 10) - 1) * 10.0 as edge
  from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 7.19 - 180 as theta from lineitem))""")
def strain_interp(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    bins = F.array(*[F.lit(float(i * 7 % 11)) for i in range(36)])
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(S.histogram_value(F.col("l_quantity") * 7.19 - 180, bins)).alias("energy"))


@query("""with t as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity * 7.19 - 180 as theta from lineitem),
d as (select *, case when ((theta - 60 + 720) % 360) > 180 then ((theta - 60 + 720) % 360) - 360 else ((theta - 60 + 720) % 360) end as d1,
  case when ((theta + 90 + 720) % 360) > 180 then ((theta + 90 + 720) % 360) - 360 else ((theta + 90 + 720) % 360) end as d2 from t)
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  round(case when abs(d1) <= 40 then 2e-3 * pow(d1, 2) + 5e-7 * pow(d1, 4) when abs(d2) <= 30 then 1e-3 * pow(d2, 2) + 2.5e-7 * pow(d2, 4) else 100 end, 6) as energy,
  not (abs(d1) <= 40 or abs(d2) <= 30) as not_observed from d""")
def strain_quartic(spark: SparkSession, sf: str) -> DataFrame:
    peaks = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("theta_0", "tolerance2", "beta_1", "beta_2"), row)]) for row in ((60.0, 40.0, 2e-3, 5e-7), (-90.0, 30.0, 1e-3, 2.5e-7))])
    s = S.quartic_strain(F.col("l_quantity") * 7.19 - 180, peaks)
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(s["energy"]).alias("energy"), s["not_observed"].alias("not_observed"))


@query("""select vec_id, round(list_min(list_transform(range(0, 20), lambda i: sqrt(pow(v[3 * i + 1] - 0.1, 2) + pow(v[3 * i + 2] - 0.2, 2) + pow(v[3 * i + 3] + 0.3, 2)))), 6) as distance
from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings)""")
def min_distance_3d(spark: SparkSession, sf: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    e = read_table(spark, sf, "embeddings").select("vec_id", v.alias("v"))
    at = lambda i, k: F.get(F.col("v"), i * 3 + k)
    d = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: S.distance((at(i, 0), at(i, 1), at(i, 2)), (F.lit(0.1), F.lit(0.2), F.lit(-0.3))))
    return e.select("vec_id", r6(F.array_min(d)).alias("distance"))


_P = ", ".join(f"v[{3 * i + 1}] as {n}x, v[{3 * i + 2}] as {n}y, v[{3 * i + 3}] as {n}z" for i, n in enumerate("pqrs"))
_U = ", ".join(f"({b}x - {a}x) as {n}x, ({b}y - {a}y) as {n}y, ({b}z - {a}z) as {n}z" for n, a, b in (("f", "p", "q"), ("g", "q", "r"), ("h", "r", "s")))
_N = ", ".join(f"{n}{c} / sqrt({n}x * {n}x + {n}y * {n}y + {n}z * {n}z) as {n}{c}" for n in "fgh" for c in "xyz")


def _cross(n: str, a: str, b: str) -> str:
    return f"{a}y * {b}z - {a}z * {b}y as {n}x, {a}z * {b}x - {a}x * {b}z as {n}y, {a}x * {b}y - {a}y * {b}x as {n}z"


@query(f"""with p as (select vec_id, {_P} from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings)),
d as (select vec_id, {_U} from p), u as (select vec_id, {_N} from d), n as (select *, {_cross('a', 'f', 'g')}, {_cross('e', 'g', 'h')} from u), m as (select *, {_cross('m', 'a', 'g')} from n)
select vec_id, round(-degrees(atan2(mx * ex + my * ey + mz * ez, ax * ex + ay * ey + az * ez)), 6) as theta from m""")
def dihedral_angle(spark: SparkSession, sf: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    e = read_table(spark, sf, "embeddings").select("vec_id", v.alias("v"))
    points = [F.struct(*[F.col("v")[3 * i + k].alias(c) for k, c in enumerate("xyz")]) for i in range(4)]
    return e.select("vec_id", r6(S.dihedral(*points)).alias("theta"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(case when d > 180 then d - 360 else d end, 6) as diff from (
  select *, ((l_quantity * 13.7 - l_linenumber * 101) % 360 + 360) % 360 as d from lineitem)""")
def angle_wrap(spark: SparkSession, sf: str) -> DataFrame:
    d = S.angle_difference(F.col("l_quantity") * 13.7, F.col("l_linenumber") * 101.0)
    return read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(d).alias("diff"))


@query("""with m as (select l_orderkey as compound, l_partkey % 5 as a2, l_suppkey % 5 as a3, l_linenumber as a4, l_partkey as rule, l_suppkey as seq, l_quantity as energy, l_returnflag = 'A' as specific, l_tax > 0.07 as not_observed, l_linenumber as a1 from lineitem),
c as (select compound, case when a2 > a3 then a4 else a1 end as a1, least(a2, a3) as a2, greatest(a2, a3) as a3, case when a2 > a3 then a1 else a4 end as a4, rule, seq, energy, specific, not_observed from m),
w1 as (select * from c qualify row_number() over (partition by compound, a1, a2, a3, a4 order by rule, seq, energy) = 1),
w2 as (select * from w1 qualify row_number() over (partition by compound, a2, a3 order by specific desc, energy desc, rule, seq, a1, a4) = 1)
select compound, cast(sum(energy) as double) as total, max(energy) as single, bool_or(not_observed) as flagged, count(*) as n_torsions from w2 group by 1""")
def strain_precedence(spark: SparkSession, sf: str) -> DataFrame:
    from sievespark.operators.strain import combine_matches

    li = read_table(spark, sf, "lineitem")
    m = li.select(F.col("l_orderkey").alias("compound"), F.col("l_linenumber").alias("a1"), (F.col("l_partkey") % 5).alias("a2"), (F.col("l_suppkey") % 5).alias("a3"), F.col("l_linenumber").alias("a4"), F.col("l_partkey").alias("rule"), F.col("l_suppkey").alias("seq"), F.col("l_quantity").alias("energy"), (F.col("l_returnflag") == "A").alias("specific"), (F.col("l_tax") > 0.07).alias("not_observed"))
    return combine_matches(m)


# ---- Text records ----------------------------------------------------------------------------


@query("""select doc_id, array_to_string(list_concat([w[3]], w[1:2], w[4:]), ' ') as reordered from (select doc_id, string_split(text, ' ') as w from documents) where len(w) >= 3""")
def winner_first_reorder(spark: SparkSession, sf: str) -> DataFrame:
    d = read_table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w")).where(F.size("w") >= 3)
    return d.select("doc_id", F.array_join(S.winner_first(F.col("w"), F.lit(2)), " ").alias("reordered"))


@query("""select event_id, format('{:.6g}', value / 1e3) as six, format('{:.3g}', -value * 1e5) as three, format('{:.6g}', event_id / 8.0 + 100000) as halves from events""")
def significant_digits(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", S.significant(F.col("value") / 1e3).alias("six"), S.significant(-F.col("value") * 1e5, 3).alias("three"), S.significant(F.col("event_id") / 8.0 + 100000).alias("halves"))


@query("""select event_id, event_type as role, printf('%.3f', value) as score, cast(user_id as varchar) as compound_id, 4 as n_tags from events""")
def sdf_property_map(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    block = S.add_properties(F.lit("name\n\nM  END\n$$$$\n"), {"COMPOUND_ID": F.lit("overwritten"), "ROLE": F.col("event_type"), "SCORE": F.format_string("%.3f", F.col("value")), "EMPTY": F.lit(None)})
    again = S.add_properties(block, {"COMPOUND_ID": F.col("user_id")})
    tags = S.let(lambda m: F.struct(m["ROLE"].alias("role"), m["SCORE"].alias("score"), m["COMPOUND_ID"].alias("compound_id"), F.size(m).alias("n_tags")), m=S.property_map(again))
    return e.select("event_id", tags.alias("tags")).select("event_id", "tags.*")


@query("""select event_id, cast(nullif(regexp_extract(props, '"k":\\s*(-?[\\d.]+)', 1), '') as double) as score from events""")
def regex_score(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", S.pose_score(F.regexp_replace("props", r'"k":', "ENERGY=")).alias("score"))


@query("""select user_id, event_id, row_number() over w as serial, coalesce(lag(event_type) over w <> event_type, false) as ter_before
from events window w as (partition by user_id order by event_id)""")
def ter_insertion(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return P.number_fragments(e, ["user_id"], ["event_id"], "event_type").select("user_id", "event_id", big("serial").alias("serial"), "ter_before")


# Receptor lines: a supplier's lineitems are a file, part and order numbers make atom names and residues.
ATOM_NAMES = ("CAY", "HY1", "HY", "CY", "HAY2", "NT", "HNT", "HAT1", "CA", "N", "HYX")
RESIDUES = (24, 316, 245, 422, 100, 300)
ATOMS = f"""raw as (select l_suppkey as file, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + cast(l_quantity as bigint) as line_no, ({list(ATOM_NAMES)})[l_partkey % {len(ATOM_NAMES)} + 1] as atom,
  ({list(RESIDUES)})[l_orderkey % {len(RESIDUES)} + 1] as resnum, l_quantity as x, l_linenumber % 2 as kind from lineitem),
routed as (select *, atom in ('CAY', 'HY1', 'CY', 'HAY2') and resnum in (24, 316) as ace, atom in ('NT', 'HNT', 'HAT1') and resnum in (245, 422) as nme,
  atom = 'HY' and resnum in (24, 316) as stray from raw),
named as (select file, line_no, x, kind, resnum, atom, case when ace or nme then 'cap' when stray then 'drop' else 'body' end as part,
  case when ace or nme then case atom when 'CAY' then 'CH3' when 'HY1' then 'HH31' when 'CY' then 'C' when 'HAY2' then 'HH32' when 'NT' then 'N' when 'HNT' then 'H' else 'HH31' end else atom end as name,
  case when ace then 'ACE' when nme then 'NME' else 'GLY' end as residue,
  case when ace then resnum - 1 when nme then resnum + 1 else resnum end as number,
  case when ace or nme then case when resnum in (24, 245) then 1 else 2 end when resnum <= 245 then 1 else 2 end as fragment from routed)"""


def receptor_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    pick = lambda values, key: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))
    name = pick(ATOM_NAMES, "l_partkey")
    field = F.when(F.length(name) < 4, F.concat(F.lit(" "), F.rpad(name, 3, " "))).otherwise(name)
    kind = F.when(F.col("l_linenumber") % 2 == 0, "ATOM  ").otherwise("HETATM")
    number = F.lpad(pick(RESIDUES, "l_orderkey").cast("string"), 4, " ")
    x = F.lpad(F.format_string("%.3f", F.col("l_quantity").cast("double")), 8, " ")
    value = F.concat(kind, F.lit("    0 "), field, F.lit(" GLY A"), number, F.lit("    "), x, F.lit("   1.000   2.000  0.50  3.25           C"))
    return li.select(F.col("l_suppkey").alias("file"), (((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 100 + F.col("l_quantity").cast("long")).alias("line_no"), value.alias("value"))


@query(f"with {ATOMS} select file, part, name, residue, cast(number as integer) as number, cast(fragment as integer) as fragment, count(*) as n, sum(cast(x as double)) as sum_x from named group by all")
def cap_routing(spark: SparkSession, sf: str) -> DataFrame:
    routed = P.route(P.atoms(receptor_lines(spark, sf)))
    return routed.groupBy("file", "part", "name", "residue", "number", "fragment").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sum_x"))


@query(f"""with {ATOMS}, files as (select distinct file from named), sites as (select unnest(['ACE', 'ACE', 'NME', 'NME']) as residue, unnest([23, 315, 246, 423]) as number),
found as (select file, residue, number, count(*) as n from named where part = 'cap' group by all)
select file, residue, cast(number as integer) as number, coalesce(n, 0) as n, coalesce(n, 0) = 6 as complete from files cross join sites left join found using (file, residue, number)""")
def cap_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return P.cap_sizes(P.route(P.atoms(receptor_lines(spark, sf))), ["file"])


@query(f"""with {ATOMS}, placed as (select *, row_number() over w as serial, coalesce(lag(fragment) over w <> fragment, false) as ter
    from named where part <> 'drop' window w as (partition by file order by number, line_no)),
fmt as (select *, case when length(name) < 4 then ' ' || rpad(name, 3, ' ') else name end as field from placed),
body as (select file, serial, ter, case when part = 'cap'
    then 'ATOM  ' || lpad(serial::varchar, 5, ' ') || ' ' || field || ' ' || residue || ' A' || lpad(number::varchar, 4, ' ') || '    ' || lpad(printf('%.3f', x::double), 8, ' ') || '   1.000   2.000  0.50  3.25           ' || name[1]
    else case when kind = 0 then 'ATOM  ' else 'HETATM' end || lpad(serial::varchar, 5, ' ') || ' ' || field || ' GLY A' || lpad(resnum::varchar, 4, ' ') || '    ' || lpad(printf('%.3f', x::double), 8, ' ') || '   1.000   2.000  0.50  3.25           C' end as value from fmt),
ends as (select file, max(serial) + 1 as serial from body group by file)
select file, serial, 1 as place, value from body union all select file, serial, 0, 'TER   ' || lpad(serial::varchar, 5, ' ') from body where ter
union all select file, serial, 0, 'TER   ' || lpad(serial::varchar, 5, ' ') from ends union all select file, serial, 1, 'END' from ends""")
def capped_receptors(spark: SparkSession, sf: str) -> DataFrame:
    out = P.capped_lines(receptor_lines(spark, sf), ["file"])
    # A line's serial: its own, or for TER and END the one that would come next.
    ter = F.col("value").startswith("TER")
    return out.select("file", F.col("seq.a").alias("serial"), F.when(ter, 0).otherwise(1).alias("place"), "value")


@query("""select user_id, event_id, case when event_type = 'click' and lead(event_type) over w = 'view' then true else false end as ter_after
from events window w as (partition by user_id order by event_id)""")
def gap_marks(spark: SparkSession, sf: str) -> DataFrame:
    code = F.when(F.col("event_type") == "click", "   1").when(F.col("event_type") == "view", "   2")
    line = F.when(code.isNotNull(), F.concat(F.rpad(F.lit("ATOM"), 22, " "), code)).otherwise("REMARK")
    lines = read_table(spark, sf, "events").select("user_id", F.col("event_id").alias("line_no"), line.alias("value"))
    return P.gap_marks(lines, 1, ["user_id"]).select("user_id", F.col("line_no").alias("event_id"), "ter_after")


@query(r"""with b as (select doc_id, unnest(range(1, len(parts) + 1)) as i, parts from (select doc_id, string_split(text, chr(10)) as parts from documents where text is not null))
select doc_id, i - 1 as pose_idx, case when i < len(parts) then parts[i] || '$$$$' || chr(10) else parts[i] end as block from b
where i < len(parts) or regexp_replace(parts[i], '\\s', '', 'g') <> ''""")
def block_splitter(spark: SparkSession, sf: str) -> DataFrame:
    """A document's lines stand for blocks: each line end becomes a terminator.

    A block ends at the first $$$$ wherever it is, so a text's own dollars are written otherwise
    (as SOH b, and SOH as SOH a) until the blocks are split.
    """
    swap = lambda c, *pairs: F.replace(swap(c, *pairs[:-1]), *[F.lit(x) for x in pairs[-1]]) if pairs else c
    text = swap(F.col("text"), ("\1", "\1a"), ("$", "\1b"), ("\n", "$$$$\n"))
    d = read_table(spark, sf, "documents").select("doc_id", F.posexplode(S.split_blocks(text)).alias("pose_idx", "block"))
    return d.select("doc_id", big("pose_idx").alias("pose_idx"), swap(F.col("block"), ("\1b", "$"), ("\1a", "\1")).alias("block"))


@query(r"""select o_orderkey, replace(o_orderpriority, '-', '#') || case when o_orderkey % 3 = 0 then '.v2' else '' end as stem from orders""")
def file_stems(spark: SparkSession, sf: str) -> DataFrame:
    """Names of files in folders, with encoded characters, dots inside, and endings of either case."""
    name = F.concat(F.replace("o_orderpriority", F.lit("-"), F.lit("%23")), F.when(F.col("o_orderkey") % 3 == 0, ".v2").otherwise(""))
    folder = F.when(F.col("o_orderkey") % 2 == 0, "file:/poses/x%20y/").otherwise("hdfs://host/a.sdf/b/")
    path = F.concat(folder, F.replace(name, F.lit(" "), F.lit("%20")), F.lit(".sdf"))
    return read_table(spark, sf, "orders").select("o_orderkey", S.file_stem(path).alias("stem"))


@query(f"""with {ATOMS}, one as (select file, resnum, count(*) as n, max(x) as x from raw where atom = 'CAY' and x >= 48 group by file, resnum)
select file, cast(resnum as integer) as resnum, n, cast(case when n = 1 then x end as double) as x from one""")
def target_atoms(spark: SparkSession, sf: str) -> DataFrame:
    """How often a target atom far out is there in each file and residue; its x where it is there once."""
    rec = P.atoms(receptor_lines(spark, sf)).where((F.col("atom") == "CAY") & (F.col("x") >= 48))
    found = rec.groupBy("file", "resnum").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x"))
    return found.select("file", "resnum", "n", F.when(F.col("n") == 1, F.col("x")).alias("x"))


@query("""select l_orderkey, case when bad then 'error' when near > 0 then 'True' else 'False' end as passed,
  case when bad then 'bad score' when near = 0 and charged = 0 then 'no charge' end as error from (
  select l_orderkey, bool_or(l_linenumber = 7) as bad, count(*) filter (l_returnflag = 'R' and l_linestatus = 'F') as charged,
    count(*) filter (l_returnflag = 'R' and l_linestatus = 'F' and l_quantity <= 5) as near from lineitem group by l_orderkey)""")
def geometric_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Real pose blocks: a line item is a pose, unreadable for status O, charged for flag R, its score no number for line 7."""
    from sievespark.plans.funnel import BAD_SCORE, NO_CHARGE, geometric_filter

    li = read_table(spark, sf, "lineitem")
    atom = F.concat(F.lpad(F.format_string("%.4f", F.col("l_quantity").cast("double")), 10, " "), F.lit("    0.0000    0.0000 N   0  0\n"))
    charge = F.when(F.col("l_returnflag") == "R", "M  CHG  1   1   1\n").otherwise("")
    score = F.when(F.col("l_linenumber") == 7, "1.2.3").otherwise(F.format_string("%.2f", -F.col("l_extendedprice")))
    block = F.concat(F.lit("m\n\n\n  1  0  0  0  0  0  0  0  0  0999 V2000\n"), atom, charge, F.lit("M  END\n> <R>\nENERGY= "), score, F.lit("\n\n$$$$\n"))
    block = F.when(F.col("l_linestatus") == "F", block).otherwise(F.concat(F.lit("unreadable ENERGY= "), score, F.lit("\n$$$$\n")))
    poses_ = li.select(F.col("l_orderkey").alias("compound_id"), F.col("l_linenumber").alias("pose_idx"), block.alias("block")).withColumn("score", S.pose_score(F.col("block")))
    report, _ = geometric_filter(poses_, (0.0, 0.0, 0.0))
    error = F.when(F.col("error").startswith(BAD_SCORE), "bad score").when(F.col("error") == NO_CHARGE, "no charge")
    return report.select(F.col("compound_id").alias("l_orderkey"), "passed", error.alias("error"))


# ---- Contacts --------------------------------------------------------------------------------


@query("""with g as (select o_orderkey, (o_totalprice % 40) - 20 as bx, (o_custkey % 37) - 18.0 as by_, (o_orderkey % 41) - 20.0 as bz from orders),
m as (select o_orderkey, 0.6 * bx - 0.8 * by_ + 1 as x, 0.8 * bx + 0.6 * by_ - 2 as y, bz + 0.5 as z,
  0.6 * (bx - 1) - 0.8 * (by_ - 0.5) + 1 as ax, 0.8 * (bx - 1) + 0.6 * (by_ - 0.5) - 2 as ay, (bz - 0.25) + 0.5 as az from g),
s as (select s_suppkey as resnum, n_name as resname, (s_acctbal % 30) - 15 as x, (s_suppkey % 29) - 14.0 as y, (s_suppkey % 31) - 15.0 as z from supplier join nation on s_nationkey = n_nationkey),
near as (select o_orderkey, resname || resnum as residue, sqrt((m.x - s.x) ** 2 + (m.y - s.y) ** 2 + (m.z - s.z) ** 2) as distance, resnum, resname from m join s on abs(m.x - s.x) <= 6 and abs(m.y - s.y) <= 6 and abs(m.z - s.z) <= 6),
best as (select * from near where distance <= 6 qualify row_number() over (partition by o_orderkey order by distance, resnum, resname) = 1)
select o_orderkey, round(sqrt((x - 1) ** 2 + (y - 2) ** 2 + (z - 3) ** 2), 6) as offset_, round(degrees(acos(greatest(-1, least(1, ((x - ax) * 1 + (y - ay) * 1 + (z - az) * 0) /
  (sqrt((x - ax) ** 2 + (y - ay) ** 2 + (z - az) ** 2) * sqrt(2)))))), 4) as angle, residue, round(distance, 6) as distance, coalesce(distance <= 3.5, false) as contact
from m left join best using (o_orderkey)""")
def group_contacts(spark: SparkSession, sf: str) -> DataFrame:
    """An order is a pose with one group of two atoms, a supplier is a residue's atom."""
    from sievespark.operators import contacts

    o = read_table(spark, sf, "orders")
    b = [F.col("o_totalprice") % 40 - 20, F.col("o_custkey") % 37 - 18.0, F.col("o_orderkey") % 41 - 20.0]
    groups = o.select("o_orderkey", *[c.alias(f"b{x}") for c, x in zip(b, "xyz")], *[(c - d).alias(f"a{x}") for c, d, x in zip(b, (1.0, 0.5, 0.25), "xyz")])
    near = read_table(spark, sf, "supplier").join(read_table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    structure = near.select((F.col("s_acctbal") % 30 - 15).alias("x"), (F.col("s_suppkey") % 29 - 14.0).alias("y"), (F.col("s_suppkey") % 31 - 15.0).alias("z"), F.col("n_name").alias("resname"), F.col("s_suppkey").alias("resnum"))
    matrix = ((0.6, -0.8, 0, 1), (0.8, 0.6, 0, -2), (0, 0, 1, 0.5))
    out = contacts.group_contacts(groups, ["o_orderkey"], structure, ((0, 1, 3), (1, 2, 3)), matrix)
    return out.select("o_orderkey", r6("offset").alias("offset_"), F.round("angle", 4).alias("angle"), "residue", r6("distance").alias("distance"), "contact")
