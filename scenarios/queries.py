"""One query per operator. Each reads whole tables; thresholds such as the
watermark are taken from the data, so the work grows with it.

Roles: ``src`` is orders with a soft-delete flag on finished ones; ``dst`` is
what a destination holds after an earlier, incomplete copy: the lower half of
the keys with holes, and a few keys beyond the watermark that will conflict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.keys import after, after_watermark
from rowferry.functions.types import type_name, types_compatible
from rowferry.operators import classify as C
from rowferry.operators import compat, loads, paging, profile
from rowferry.operators.constraints import classify_constrained
from rowferry.operators.diff import table_diff
from rowferry.operators.ranks import RankIndex
from rowferry.operators.sketches import key_sketch, merge_sketches
from rowferry.operators.sketches import sketch_profile as profile_of
from rowferry.plans import modes
from rowferry.plans import state as S
from rowferry.plans.sync import RunResult, SyncError, full_load, sync
from rowferry.sources import template
from rowferry.sources.jdbc import stripe_predicates
from rowferry.sources.keyset import register as register_keyset
from rowferry.sources.table import DestTable
from rowferry.sources.workdir import work_path, write_through
from rowferry.spec import DestSpec, JobSpec
from rowferry.streaming.keyed import stream_keyed
from rowferry.streaming.stream import stream_deletes, stream_inserts

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
BATCH = 1000
JOIN_QUERY = """
    SELECT o.o_orderkey AS id, c.c_name AS user_name, o.o_orderdate AS order_date,
           p.p_name AS product_name, l.l_quantity AS qty, l.l_extendedprice AS price
    FROM {{table}} c
    JOIN orders o ON o.o_custkey = c.c_custkey
    JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey
    WHERE o.o_orderdate >= '2000-01-01'
"""
AGGREGATE_QUERY = """
    SELECT o_custkey AS id, COUNT(*) AS n_orders, MAX(o_orderdate) AS last_order
    FROM {{table}} GROUP BY o_custkey;
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def views(spark: SparkSession, sf: str, *names: str) -> None:
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(name)


def middle(df: DataFrame, key: str) -> int:
    """The key in the middle of the key range: the scenarios' watermark."""
    return df.agg(F.expr(f"(min({key}) + max({key})) div 2")).first()[0]


def orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders")


def src(spark, sf) -> DataFrame:
    flag = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    return orders(spark, sf).withColumn("is_deleted", flag)


def dst(spark, sf, mid: int) -> DataFrame:
    old = (F.col("o_orderkey") <= mid) & (F.col("o_orderpriority") != "5-LOW")
    ahead = (F.col("o_orderkey") > mid) & (F.col("o_orderpriority") == "1-URGENT")
    return orders(spark, sf).where(old | ahead)


def src_dst(spark, sf) -> tuple[DataFrame, DataFrame, int]:
    mid = middle(orders(spark, sf), "o_orderkey")
    return src(spark, sf), dst(spark, sf, mid), mid


def fresh(mid: int) -> Column:
    return after_watermark("o_orderkey", str(mid), "bigint")


# -- extract and page ------------------------------------------------------


def extract_template(spark, sf):
    views(spark, sf, "orders")
    return template.extract(spark, "SELECT * FROM {{table}}", "orders")


def extract_join_query(spark, sf):
    views(spark, sf, "customer", "orders", "lineitem", "part")
    return template.extract(spark, JOIN_QUERY, "customer")


def extract_aggregate_query(spark, sf):
    views(spark, sf, "orders")
    mid = middle(table(spark, sf, "customer"), "c_custkey")
    return template.extract(spark, AGGREGATE_QUERY, "orders").where(after("id", [mid]))


def extract_projection(spark, sf):
    views(spark, sf, "customer")
    query = "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM {{table}}"
    return template.extract(spark, query, "customer")


def query_schema(spark, sf):
    views(spark, sf, "orders")
    return template.query_schema(template.extract(spark, AGGREGATE_QUERY, "orders"))


def keyset_page(spark, sf):
    df = orders(spark, sf)
    return paging.keyset_page(df, "o_orderkey", [middle(df, "o_orderkey")], BATCH)


def keyset_page_composite(spark, sf):
    df = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return paging.keyset_page(df, ["conv_id", "turn"], [middle(df, "conv_id"), 1], 100)


def batch_manifest(spark, sf):
    return paging.batch_manifest(orders(spark, sf), "o_orderkey", BATCH)


def batch_manifest_composite(spark, sf):
    ends = paging.batch_manifest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], BATCH)
    return ends.select(
        "batch_no",
        F.col("first_pk.l_orderkey").alias("first_order"),
        F.col("first_pk.l_linenumber").alias("first_line"),
        F.col("last_pk.l_orderkey").alias("last_order"),
        F.col("last_pk.l_linenumber").alias("last_line"),
        "n_rows",
    )


def keyset_resume(spark, sf):
    df = orders(spark, sf)
    mid = middle(df, "o_orderkey")
    return paging.keyset_resume(df, "o_orderkey", [mid], 7, BATCH).select("o_orderkey", "batch_no")


def offset_page_fallback(spark, sf):
    df = table(spark, sf, "events").select("ts", "user_id", "event_type", "value", "props", "event_id")
    return paging.offset_page(df, 2000, BATCH).select("event_id", "event_type", "value")


def jdbc_stripes(spark, sf):
    """The stripes of a parallel JDBC read cover every row exactly once."""
    df = orders(spark, sf)
    stripes = stripe_predicates("o_custkey", paging.key_cuts(df, "o_custkey", 8))
    matches = sum(F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in stripes)
    return df.groupBy(matches.alias("n_stripes")).agg(F.count(F.lit(1)).alias("n_rows"))


# -- profiles ----------------------------------------------------------------


def bad_part(spark, sf) -> DataFrame:
    """part with defects: NULL keys, NULL and long names, ranks that are no numbers."""
    economy = (F.col("p_type") == "ECONOMY") & (F.col("p_size") == 2)
    return table(spark, sf, "part").select(
        F.when(F.col("p_size") != 1, F.col("p_partkey")).alias("id"),
        F.when(~economy, F.col("p_name")).alias("name"),
        F.when(F.col("p_brand") == "Brand#1", "n/a").otherwise(F.col("p_size").cast("string")).alias("rank"),
        "p_partkey",
    )


def row_count(spark, sf):
    s, d, _ = src_dst(spark, sf)
    counted = [("src", s), ("dst", d), ("lineitem", table(spark, sf, "lineitem"))]
    return profile.stack([profile.row_count(df, name) for name, df in counted])


def deleted_count(spark, sf):
    return profile.deleted_count(src(spark, sf), "is_deleted")


def key_profile(spark, sf):
    return profile.stack(
        [
            profile.key_profile(orders(spark, sf), "o_orderkey", "orders"),
            profile.key_profile(table(spark, sf, "lineitem"), "l_orderkey", "lineitem"),
            profile.key_profile(bad_part(spark, sf), "id", "bad_part"),
        ]
    )


def table_schema(spark, sf):
    return profile.table_schema({name: table(spark, sf, name) for name in TABLES})


def preflight_report(spark, sf):
    required = [
        ("orders", "o_orderkey"),
        ("orders", "is_deleted"),
        ("lineitem", "l_orderkey"),
        ("missing_table", "id"),
    ]
    return profile.preflight_report(required, {n: table(spark, sf, n) for n in ("orders", "lineitem")})


def query_validation(spark, sf):
    """Which of several queries are valid, and what the valid ones return."""
    views(spark, sf, "orders")
    cases = {
        "ok": ("SELECT * FROM {{table}} WHERE o_orderstatus = 'F'", "orders"),
        "double_where": ("SELECT * FROM {{table}} WHERE o_orderkey > 1 WHERE o_orderkey > 2", "orders"),
        "unknown_column": ("SELECT no_such_column FROM {{table}}", "orders"),
        "missing_table": ("SELECT * FROM {{table}}", "no_such_table"),
    }
    rows = []
    for name, (query, source) in cases.items():
        valid, _ = template.check_query(spark, query, source)
        if valid:
            count = template.extract(spark, query, source).agg(F.count(F.lit(1)).alias("n_rows"))
        else:
            count = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
        rows.append(count.select(F.lit(name).alias("query_name"), F.lit(valid).alias("is_valid"), "n_rows"))
    return profile.stack(rows)


def incremental_extract(spark, sf):
    s = src(spark, sf)
    return s.where(fresh(middle(s, "o_orderkey")))


def delta_deleted_ids(spark, sf):
    return profile.deleted_keys(src(spark, sf), "o_orderkey", "is_deleted")


# -- schema compatibility ----------------------------------------------------
# A catalogue of many table pairs: each order is a pair of tables, each line
# number a column. The type codes are spread over the line's part and supplier.


def wire_code(number: Column) -> Column:
    """One of the 28 wire type codes, or 256, which is none."""
    i = number % 29
    return F.when(i <= 16, i).otherwise(i + 228).cast("int")


def catalogue_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pair"),
        F.concat(F.lit("c"), F.col("l_linenumber")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal"),
        "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )


def yes_no(cond: Column) -> Column:
    return F.when(cond, "YES").otherwise("NO")


def catalogue_pairs(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = catalogue_rows(spark, sf)
    source = rows.where(F.col("l_returnflag") != "A").groupBy("pair", "column_name").agg(
        type_name(wire_code(F.min("l_partkey"))).alias("data_type"),
        yes_no(F.max("l_discount") > 0.05).alias("is_nullable"),
    )
    dest = rows.where(F.col("l_linestatus") == "O").groupBy("pair", "column_name").agg(
        type_name(wire_code(F.min("l_suppkey"))).alias("data_type"),
        yes_no(F.max("l_tax") > 0.04).alias("is_nullable"),
    )
    return source, dest


def catalogue_keys(spark, sf) -> DataFrame:
    flag = F.max("l_returnflag")
    return catalogue_rows(spark, sf).groupBy("pair", "column_name", "ordinal").agg(
        F.when(flag == "A", "PRI").when(flag == "N", "MUL").otherwise("").alias("column_key"),
        F.when(F.max("l_linestatus") == "O", "AUTO_INCREMENT").otherwise("").alias("extra"),
    )


def type_code_map(spark, sf):
    code = wire_code(F.col("l_partkey"))
    return (
        table(spark, sf, "lineitem")
        .groupBy(code.alias("type_code"), type_name(code).alias("type_name"))
        .agg(F.count(F.lit(1)).alias("n_columns"))
    )


def type_compat_matrix(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        type_name(wire_code(F.col("l_partkey"))).alias("source_type"),
        type_name(wire_code(F.col("l_suppkey"))).alias("dest_type"),
    )
    return (
        pairs.groupBy("source_type", "dest_type")
        .agg(F.count(F.lit(1)).alias("n_columns"))
        .withColumn("compatible", types_compatible("source_type", "dest_type"))
    )


def schema_compat_report(spark, sf):
    return compat.schema_report(*catalogue_pairs(spark, sf))


def schema_verdict(spark, sf):
    return compat.schema_verdict(*catalogue_pairs(spark, sf))


def dest_pk_validation(spark, sf):
    return compat.dest_pk_report(catalogue_keys(spark, sf).withColumnRenamed("pair", "table_name"), "c1")


def pk_choice(spark, sf):
    return modes.pk_choice(catalogue_keys(spark, sf), F.lit("c2"), "pair")


# -- loads -------------------------------------------------------------------


def dest_spec(df: DataFrame, keys, **options) -> DestSpec:
    return DestSpec(schema=df.schema, primary_key=keys, **options)


LINE_KEY = ("l_orderkey", "l_linenumber")


def column_mapping_insert(spark, sf):
    customer = table(spark, sf, "customer")
    spec = dest_spec(customer, "c_custkey", defaults={"c_acctbal": 0.0})
    return loads.map_columns(customer.select("c_custkey", "c_name"), spec)


def full_load_accepted(spark, sf):
    return C.accepted(table(spark, sf, "lineitem"), LINE_KEY).select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


def full_load_rejects(spark, sf):
    line = table(spark, sf, "lineitem")
    return C.rejected(C.classify(line, dest_spec(line, LINE_KEY))).select(
        *LINE_KEY, "l_partkey", "l_suppkey", F.col("_reason").alias("reason")
    )


def incremental_accepted(spark, sf):
    s, d, mid = src_dst(spark, sf)
    return C.accepted(s.where(fresh(mid)), "o_orderkey", d.where(fresh(mid)))


def incremental_first_run(spark, sf):
    s, d, _ = src_dst(spark, sf)
    return C.accepted(s, "o_orderkey", d)


def incremental_rejects(spark, sf):
    s, d, mid = src_dst(spark, sf)
    outcome = C.classify(s.where(fresh(mid)), dest_spec(s, "o_orderkey"), d.where(fresh(mid)))
    return C.rejected(outcome).select("o_orderkey", F.col("_reason").alias("reason"))


def part_spec() -> DestSpec:
    schema = T.StructType().add("id", "long").add("name", "string", False).add("rank", "integer").add("p_partkey", "long")
    return DestSpec(schema, "id", max_length={"name": 9})


def constraint_rejects(spark, sf):
    outcome = C.classify(bad_part(spark, sf), part_spec())
    return C.rejected(outcome).select("p_partkey", F.col("_reason").alias("reason"))


def reject_table(spark, sf):
    """Dead letters, with two fields read back from the stored JSON."""
    dead = C.reject_table(C.classify(bad_part(spark, sf), part_spec()), "run-1")
    return dead.select(
        "run_id",
        "reason",
        F.get_json_object("row", "$.p_partkey").cast("long").alias("p_partkey"),
        F.get_json_object("row", "$.rank").alias("rank"),
    )


def classified_load(spark, sf):
    """Every outcome of one load, counted: nothing is lost between them."""
    line = table(spark, sf, "lineitem")
    late = line.where(F.col("l_linestatus") == "F").select(*LINE_KEY)
    outcome = C.classify(line, dest_spec(line, LINE_KEY), late.distinct())
    return outcome.groupBy(F.coalesce("_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_partkey").alias("sum_partkey")
    )


def full_load_hot_keys(spark, sf):
    """Three keys hold all rows, which are ranked by the reading task and then once more."""
    line = table(spark, sf, "lineitem")
    outcome = C.classify(line, dest_spec(line, "l_returnflag"))
    return outcome.select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_returnflag", F.coalesce("_reason", F.lit("accepted")).alias("outcome")
    )


def full_load_joined_hot_keys(spark, sf):
    """As ``full_load_hot_keys``, of a query that ends in a join on the hot key: all its rows come from one task."""
    line = table(spark, sf, "lineitem")
    names = line.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_flag")).hint("shuffle_hash")
    joined = line.join(names, "l_returnflag").select(*LINE_KEY, "l_partkey", "l_suppkey", "l_returnflag", "n_flag")
    outcome = C.classify(joined, dest_spec(joined, "l_returnflag"))
    return outcome.select(
        *LINE_KEY, "l_partkey", "l_suppkey", "l_returnflag", "n_flag", F.coalesce("_reason", F.lit("accepted")).alias("outcome")
    )


def part_rules(spark, sf) -> tuple[DataFrame, DestSpec]:
    """Parts whose price names them, with two more unique keys, a check and a parent table."""
    table(spark, sf, "nation").createOrReplaceTempView("origins")
    rows = table(spark, sf, "part").select(
        F.round(F.col("p_retailprice") * 10).cast("long").alias("id"), "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        (F.col("p_partkey") % 27).cast("int").alias("origin"),
    )
    spec = dest_spec(
        rows, "id", unique={"name": ("p_name", "p_brand"), "kind": ("p_brand", "p_type", "p_size")},
        checks={"size": "p_size <= 45"}, foreign_keys={"origin": (("origin",), "origins", ("n_nationkey",))},
    )
    return rows, spec


def multi_unique_rejects(spark, sf):
    """What a destination with three unique keys, a check and a foreign key refuses of a full load."""
    rows, spec = part_rules(spark, sf)
    return C.rejected(classify_constrained(rows, spec)).select("id", "p_partkey", F.col("_reason").alias("reason"))


def sync_constraints(spark, sf):
    """A run into such a destination, which holds the parts of every third origin already."""
    rows, spec = part_rules(spark, sf)
    rows.createOrReplaceTempView("priced_parts")
    dest, store = workplace(spark, spec, "sync-constraints")
    held = classify_constrained(rows.where(F.col("origin") % 3 == 0), spec)
    dest.load(held.where("_reason is null").select(*rows.columns))
    job = JobSpec("parts", "priced_parts", "parts", "id", source_keys=("id",))
    completed(sync(spark, job, dest, store), "incremental")
    return dest.read()


def _batch_rows(spark, sf) -> DataFrame:
    s, d, _ = src_dst(spark, sf)
    outcome = C.classify(s, dest_spec(s, "o_orderkey"), d)
    return outcome.select("o_orderkey", F.col("_reason").isNull().alias("accepted"))


def batch_metrics(spark, sf):
    return loads.batch_metrics(_batch_rows(spark, sf), "o_orderkey", "accepted", BATCH).drop("rows_done")


def load_progress(spark, sf):
    rows = src(spark, sf)
    metrics = loads.batch_metrics(rows.withColumn("accepted", F.lit(True)), "o_orderkey", "accepted", BATCH)
    return loads.load_progress(metrics, rows.count()).select("batch_no", "rows_done", "pct")


def delta_apply(spark, sf):
    s, d, _ = src_dst(spark, sf)
    return loads.delta_apply(d, s, "o_orderkey", "is_deleted")


def delta_effect(spark, sf):
    s, d, _ = src_dst(spark, sf)
    return loads.delta_effect(d, s, "o_orderkey", "is_deleted", BATCH)


# -- state -------------------------------------------------------------------
# Long histories: each event is a watermark write, each order a checkpoint.


def watermark_history(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat(F.lit("job"), F.col("user_id")).alias("job"),
        F.col("event_type").alias("source_table"),
        F.lit("ev").alias("dest_table"),
        F.lit("event_id").alias("pk"),
        F.col("event_id").cast("string").alias("value"),
        F.lit("bigint").alias("value_type"),
        F.col("event_id").alias("seq"),
    )


def checkpoint_history(spark, sf) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "P", S.IN_PROGRESS).otherwise(S.COMPLETED)
    return orders(spark, sf).select(
        F.concat(F.lit("job"), F.col("o_custkey")).alias("job"),
        F.lit("orders").alias("source_table"),
        F.col("o_orderpriority").alias("dest_table"),
        F.lit("full").alias("mode"),
        F.col("o_orderkey").cast("string").alias("last_pk"),
        F.expr("o_orderkey div 1000 + 1").alias("batch_no"),
        status.alias("status"),
        F.col("o_orderkey").alias("seq"),
    )


def watermark_lookup(spark, sf):
    return S.watermark_lookup(watermark_history(spark, sf))


def watermark_upsert(spark, sf):
    writes = (
        orders(spark, sf)
        .groupBy("o_custkey")
        .agg(F.max("o_orderkey").alias("seq"))
        .select(
            F.concat(F.lit("job"), F.col("o_custkey")).alias("job"),
            F.lit("view").alias("source_table"),
            F.lit("ev").alias("dest_table"),
            F.lit("event_id").alias("pk"),
            F.concat(F.lit("1"), F.col("seq")).alias("value"),
            F.lit("bigint").alias("value_type"),
            "seq",
        )
    )
    # Writes come after all of the history.
    top = table(spark, sf, "events").agg(F.max("event_id")).first()[0]
    return S.upsert(
        watermark_history(spark, sf), writes.withColumn("seq", F.col("seq") + F.lit(top + 1)), S.WATERMARK_KEY
    ).drop("seq")


def watermark_advance(spark, sf):
    s = src(spark, sf)
    return S.watermark_advance(s.where(fresh(middle(s, "o_orderkey"))), "o_orderkey")


def checkpoint_lookup(spark, sf):
    return S.checkpoint_lookup(checkpoint_history(spark, sf)).select("job", "dest_table", "mode", "last_pk", "batch_no")


def checkpoint_upsert(spark, sf):
    history = checkpoint_history(spark, sf)
    mid = middle(orders(spark, sf), "o_orderkey")
    later = history.where(F.col("seq") > mid).withColumn("status", F.lit(S.IN_PROGRESS))
    current = S.upsert(history.where(F.col("seq") <= mid), later, S.CHECKPOINT_KEY)
    return current.select("job", "dest_table", "mode", "last_pk", "status")


def checkpoint_complete(spark, sf):
    current = S.latest(checkpoint_history(spark, sf), S.CHECKPOINT_KEY)
    done = S.checkpoint_complete(current, F.col("dest_table") == "1-URGENT")
    return done.select("job", "dest_table", "mode", "status")


def state_clear(spark, sf):
    current = S.latest(checkpoint_history(spark, sf), S.CHECKPOINT_KEY)
    kept, _ = S.state_clear(current, S.scope("orders", "1-URGENT"))
    return kept.select("job", "source_table", "dest_table", "mode")


def state_clear_count(spark, sf):
    current = S.latest(checkpoint_history(spark, sf), S.CHECKPOINT_KEY)
    return S.state_clear(current, S.scope("orders", "1-URGENT"))[1]


def delete_log(spark, sf, mid: int) -> DataFrame:
    known = src(spark, sf).where(profile.is_flagged("is_deleted") & (F.col("o_orderkey") <= mid))
    return known.select(
        F.col("o_orderkey").alias("record_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("processed"),
    )


def delete_log_merge(spark, sf):
    s = src(spark, sf)
    flagged = profile.deleted_keys(s, "o_orderkey", "is_deleted").select(F.col("o_orderkey").alias("record_id"))
    return S.delete_log_merge(delete_log(spark, sf, middle(s, "o_orderkey")), flagged)


def delete_log_pending(spark, sf):
    return S.delete_log_pending(delete_log(spark, sf, middle(orders(spark, sf), "o_orderkey")))


def delete_log_mark(spark, sf):
    done = src(spark, sf).where(F.col("o_totalprice") > 250000).select(F.col("o_orderkey").alias("record_id"))
    return S.delete_log_mark(delete_log(spark, sf, middle(orders(spark, sf), "o_orderkey")), done)


def run_summary(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("event_type").alias("mode"),
        F.col("user_id").alias("rows_processed"),
        F.when(F.col("value") < 5, "failed").otherwise("completed").alias("status"),
        F.col("value").alias("seconds"),
    )
    return S.run_summary(runs).drop("seconds")


def multi_job_state(spark, sf):
    return S.entries_per_job(
        S.watermark_lookup(watermark_history(spark, sf)),
        S.latest(checkpoint_history(spark, sf), S.CHECKPOINT_KEY),
    )


# -- decisions: every customer is a job --------------------------------------


def job_states(spark, sf) -> DataFrame:
    s, d, _ = src_dst(spark, sf)
    held = d.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("dest_rows"))
    seen = s.groupBy("o_custkey").agg(
        F.count_if(profile.is_flagged("is_deleted")).alias("flagged"),
        F.bool_or((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).alias("open"),
    )
    jobs = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return (
        jobs.join(held, "o_custkey", "left")
        .join(seen, "o_custkey", "left")
        .select(
            F.col("o_custkey").alias("job"),
            "c_mktsegment",
            F.coalesce("dest_rows", F.lit(0)).alias("dest_rows"),
            F.coalesce("flagged", F.lit(0)).alias("flagged"),
            (F.col("c_mktsegment") != "BUILDING").alias("has_flag"),
            (F.col("c_nationkey") < 20).alias("has_pk"),
            F.lit("o_orderkey").alias("pk"),
            (F.col("c_acctbal") < 0).alias("force"),
            F.coalesce("open", F.lit(False)).alias("has_checkpoint"),
        )
    )


def mode_detect(spark, sf):
    return modes.mode_detect(job_states(spark, sf)).select("job", "mode", "reason")


def mode_forced(spark, sf):
    segment = F.col("c_mktsegment")
    forced = (
        F.when(segment == "AUTOMOBILE", "full")
        .when(segment == "BUILDING", "incremental")
        .when(segment == "FURNITURE", "delta")
        .otherwise(F.lower(segment))
    )
    jobs = table(spark, sf, "customer").select(F.col("c_custkey").alias("job"), "c_mktsegment")
    return modes.mode_forced(jobs, forced).select("job", "mode", "reason")


def fresh_start(spark, sf):
    return modes.fresh_start(job_states(spark, sf)).select("job", "clears")


# -- whole runs --------------------------------------------------------------


def workplace(spark, spec: DestSpec, label: str) -> tuple[DestTable, S.StateStore]:
    root = work_path(spark, label)
    return DestTable(spark, f"{root}/dest", spec), S.StateStore(spark, f"{root}/state")


def completed(result: RunResult, mode: str) -> None:
    if result.status != "completed" or result.mode != mode:
        raise SyncError(f"expected a completed {mode} run, got {result}")


def orders_job(spark, sf, source: str, **options) -> JobSpec:
    columns = ", ".join(orders(spark, sf).columns)
    return JobSpec(
        f"copy-{source}",
        source,
        "dst",
        "o_orderkey",
        query=f"SELECT {columns} FROM {{{{table}}}}",
        source_keys=("o_orderkey",),
        **options,
    )


def sync_full(spark, sf):
    views(spark, sf, "lineitem")
    line = table(spark, sf, "lineitem")
    dest, store = workplace(spark, dest_spec(line, LINE_KEY), "sync-full")
    job = JobSpec("lines", "lineitem", "lines", LINE_KEY)
    completed(sync(spark, job, dest, store), "full")
    return dest.read().select(*LINE_KEY, "l_partkey")


def full_load_resumed(spark, sf):
    """A load in four key ranges, stopped after two and taken up again."""
    views(spark, sf, "lineitem")
    line = table(spark, sf, "lineitem")
    dest, store = workplace(spark, dest_spec(line, LINE_KEY), "resume")
    job = JobSpec("lines", "lineitem", "lines", LINE_KEY)
    full_load(spark, job, dest, store, RunResult("first", "full"), ranges=4, stop_after=2)
    full_load(spark, job, dest, store, RunResult("second", "full"), ranges=4)
    return dest.read().select(*LINE_KEY, "l_partkey")


def _incremental(spark, sf, label: str) -> tuple[DestTable, S.StateStore]:
    views(spark, sf, "orders")
    _, d, mid = src_dst(spark, sf)
    dest, store = workplace(spark, dest_spec(d, "o_orderkey"), label)
    dest.load(d)
    job = orders_job(spark, sf, "orders", batch_history=label == "sync-batches")
    store.put(
        "watermarks", 1, job=job.name, source_table="orders", dest_table="dst",
        pk="o_orderkey", value=str(mid), value_type="bigint",
    )
    completed(sync(spark, job, dest, store), "incremental")
    return dest, store


def sync_incremental(spark, sf):
    return _incremental(spark, sf, "sync-incremental")[0].read()


def sync_batches(spark, sf):
    """The batch counters an incremental run leaves behind."""
    _, store = _incremental(spark, sf, "sync-batches")
    return store.history("batches").drop("job", "run_id", "seq")


def sync_history(spark, sf):
    """The run record and the watermark of an incremental run."""
    _, store = _incremental(spark, sf, "sync-history")
    mark = S.watermark_lookup(store.history("watermarks")).select("job", "pk", "value", "value_type")
    counters = ("rows_processed", "rows_inserted", "rows_rejected")
    return store.history("runs").select("job", "mode", "reason", *counters, "status").join(mark, "job").drop("job")


def sync_rejects(spark, sf):
    """The dead letters an incremental run leaves behind."""
    key = F.get_json_object("row", "$.o_orderkey").cast("long")
    return _incremental(spark, sf, "sync-rejects")[0].rejects().select(key.alias("o_orderkey"), "reason")


def sync_delta(spark, sf):
    s, d, _ = src_dst(spark, sf)
    s.createOrReplaceTempView("orders_flagged")
    dest, store = workplace(spark, dest_spec(d, "o_orderkey"), "sync-delta")
    dest.load(d)
    completed(sync(spark, orders_job(spark, sf, "orders_flagged"), dest, store), "delta")
    return dest.read()


def sync_sequence(spark, sf):
    """Half the orders, then all of them, then the deletions."""
    s, _, mid = src_dst(spark, sf)
    unflagged = orders(spark, sf).withColumn("is_deleted", F.lit(0))
    steps = [
        ("full", unflagged.where(F.col("o_orderkey") <= mid)),
        ("incremental", unflagged),
        ("delta", s),
    ]
    dest, store = workplace(spark, dest_spec(orders(spark, sf), "o_orderkey"), "sync-sequence")
    job = orders_job(spark, sf, "orders_in_time", seed_watermark=True)
    for mode, now in steps:
        now.createOrReplaceTempView("orders_in_time")
        completed(sync(spark, job, dest, store), mode)
    return dest.read()


def sync_text_key(spark, sf):
    """The source's key is text, the destination's a number; three runs copy each order once."""
    spec = dest_spec(orders(spark, sf).select("o_orderkey", "o_custkey"), "o_orderkey")
    dest, store = workplace(spark, spec, "sync-text-key")
    job = JobSpec(
        "text-key", "orders_text", "dst", "o_orderkey", query="SELECT o_orderkey, o_custkey FROM {{table}}",
        source_keys=("o_orderkey",), seed_watermark=True,
    )
    text = orders(spark, sf).withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    mid = middle(orders(spark, sf), "o_orderkey")
    for mode, now in (("full", text.where(F.col("o_orderkey").cast("long") <= mid)), ("incremental", text), ("incremental", text)):
        now.createOrReplaceTempView("orders_text")
        completed(sync(spark, job, dest, store), mode)
    return dest.read()


def sync_collated_key(spark, sf):
    """Names that differ in case only are one key, on either side of the watermark."""
    names = table(spark, sf, "customer").select("c_custkey", "c_name")
    mid = middle(names, "c_custkey")
    spec = DestSpec(names.schema, ("c_name",), key_collation="UTF8_LCASE")
    dest, store = workplace(spark, spec, "sync-collated-key")
    dest.load(names.where(F.col("c_custkey") <= mid).withColumn("c_name", F.upper("c_name")))
    names.withColumn("c_name", F.lower("c_name")).createOrReplaceTempView("customer_lower")
    job = JobSpec("collated", "customer_lower", "dst", "c_name", source_keys=("c_name",))
    last = dest.keys().agg(F.max("c_name")).first()[0]
    store.put(
        "watermarks", 1, job=job.name, source_table="customer_lower", dest_table="dst",
        pk="c_name", value=last, value_type="string",
    )
    completed(sync(spark, job, dest, store), "incremental")
    return dest.read()


def sync_zone_watermark(spark, sf):
    """Instants as keys, an hour apart and so across clock changes; the runs' sessions are in two zones."""
    instant = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("event_id") * F.lit(3_600_000_000))
    rows = table(spark, sf, "events").select(instant.alias("at"), "event_id")
    dest, store = workplace(spark, dest_spec(rows, "at"), "sync-zone")
    job = JobSpec("zones", "events_at", "dst", "at", source_keys=("at",), seed_watermark=True)
    mid, zone = middle(rows, "event_id"), spark.conf.get("spark.sql.session.timeZone")
    try:
        for mode, now, where in (("full", rows.where(F.col("event_id") <= mid), "UTC"), ("incremental", rows, "America/New_York")):
            spark.conf.set("spark.sql.session.timeZone", where)
            now.createOrReplaceTempView("events_at")
            completed(sync(spark, job, dest, store), mode)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    return dest.read().select(F.unix_micros("at").alias("micros"), "event_id")


def sync_delta_bad_key(spark, sf):
    """Some flagged keys are no numbers; the others are deleted all the same."""
    s, d, _ = src_dst(spark, sf)
    key = F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(""))
    s.withColumn("o_orderkey", key).createOrReplaceTempView("orders_bad_key")
    dest, store = workplace(spark, dest_spec(d, "o_orderkey"), "sync-bad-key")
    dest.load(d)
    completed(sync(spark, orders_job(spark, sf, "orders_bad_key"), dest, store), "delta")
    return dest.read()


def sync_without_key(spark, sf):
    """The query does not return the key: the run completes, and every row is a reject."""
    views(spark, sf, "customer")
    spec = dest_spec(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey")
    dest, store = workplace(spark, spec, "sync-no-key")
    job = JobSpec("no-key", "customer", "dst", "c_custkey", query="SELECT c_name FROM {{table}}")
    completed(sync(spark, job, dest, store), "full")
    if not dest.is_empty():
        raise SyncError("rows without a key were inserted")
    return dest.rejects().select("reason", F.get_json_object("row", "$.c_name").alias("c_name"))


def sync_schema_warnings(spark, sf):
    """What a run's schema check leaves behind, and the rows that were loaded all the same."""
    views(spark, sf, "customer")
    schema = T.StructType.fromDDL("c_custkey long, c_name string not null, c_acctbal string, note string")
    dest, store = workplace(spark, DestSpec(schema, "c_custkey"), "sync-warnings")
    job = JobSpec("warnings", "customer", "dst", "c_custkey", query="SELECT c_custkey, c_name, c_acctbal FROM {{table}}")
    completed(sync(spark, job, dest, store), "full")
    n_rows = dest.read().agg(F.count(F.lit(1)).alias("n_rows"))
    return store.history("schema_issues").select("column_name", "level", "issue").join(n_rows)


# -- streams -----------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def event_stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def stream_place(spark, sf, label: str):
    events = table(spark, sf, "events").select(*EVENT_COLUMNS)
    dest, store = workplace(spark, dest_spec(events, "event_id"), label)
    job = JobSpec(label, "events", "ev", "event_id")
    return events, dest, store, job, work_path(spark, f"{label}-checkpoint")


def stream_incremental(spark, sf):
    _, dest, store, job, checkpoint = stream_place(spark, sf, "stream-insert")
    for _ in range(2):
        stream = event_stream(spark, sf).select(*EVENT_COLUMNS)
        stream_inserts(stream, job, dest, store, checkpoint).awaitTermination()
    return dest.read()


def _late(spark, sf, late: str) -> DataFrame:
    events, dest, store, job, checkpoint = stream_place(spark, sf, f"stream-late-{late}")
    store.put(
        "watermarks", 1, job=job.name, source_table="events", dest_table="ev",
        pk="event_id", value=str(middle(events, "event_id")), value_type="bigint",
    )
    stream = event_stream(spark, sf).select(*EVENT_COLUMNS)
    stream_inserts(stream, job, dest, store, checkpoint, late=late).awaitTermination()
    return dest.read()


def stream_late_keys(spark, sf):
    return _late(spark, sf, "drop")


def stream_late_fill(spark, sf):
    return _late(spark, sf, "fill")


def stream_delete(spark, sf):
    events, dest, store, job, checkpoint = stream_place(spark, sf, "stream-delete")
    dest.load(events)
    flag = F.when(F.col("event_type") == "error", 1).otherwise(0)
    stream = event_stream(spark, sf).withColumn("is_deleted", flag)
    stream_deletes(stream, job, dest, store, checkpoint).awaitTermination()
    return dest.read().select("event_id", "event_type")


def stream_new_checkpoint(spark, sf):
    """Half the events by one checkpoint, then all of them by a new one, whose batches are numbered from 0 again."""
    events, dest, store, job, checkpoint = stream_place(spark, sf, "stream-again")
    mid = middle(events, "event_id")
    for where, place in ((F.col("event_id") <= mid, checkpoint), (F.lit(True), f"{checkpoint}-second")):
        stream = event_stream(spark, sf).select(*EVENT_COLUMNS).where(where)
        stream_inserts(stream, job, dest, store, place).awaitTermination()
    return dest.read()


def stream_delete_new_checkpoint(spark, sf):
    """Errors are deleted by one checkpoint, clicks by a new one."""
    events, dest, store, job, checkpoint = stream_place(spark, sf, "stream-delete-again")
    dest.load(events)
    for kind, place in (("error", checkpoint), ("click", f"{checkpoint}-second")):
        flag = F.when(F.col("event_type") == kind, 1).otherwise(0)
        stream_deletes(event_stream(spark, sf).withColumn("is_deleted", flag), job, dest, store, place).awaitTermination()
    left = store.delete_log(job).where("processed = 0").count()
    if left:
        raise SyncError(f"{left} ids are still pending")
    return dest.read().select("event_id", "event_type")


def offset_page_deep(spark, sf):
    """A page far into the longest table."""
    line = table(spark, sf, "lineitem")
    return paging.offset_page(line, line.count() // 2, BATCH).select(*LINE_KEY, "l_partkey", "l_suppkey")


def full_load_resumed_text(spark, sf):
    """As ``full_load_resumed``, in four ranges of a key that is text."""
    names = table(spark, sf, "customer").select("c_name", "c_custkey", "c_acctbal")
    names.createOrReplaceTempView("customer_names")
    dest, store = workplace(spark, dest_spec(names, "c_name"), "resume-text")
    job = JobSpec("names", "customer_names", "names", "c_name")
    full_load(spark, job, dest, store, RunResult("first", "full"), ranges=4, stop_after=2)
    full_load(spark, job, dest, store, RunResult("second", "full"), ranges=4)
    return dest.read()


# -- destinations of many commits ------------------------------------------------


def delete_bitmaps(spark, sf):
    """Two loads, two deletes that meet rows of both, a key that comes back, and a compaction of the worn buckets."""
    s, d, mid = src_dst(spark, sf)
    dest, _ = workplace(spark, dest_spec(d, "o_orderkey"), "bitmaps")
    dest.load(d.where(F.col("o_orderkey") <= mid), "low")
    flagged = s.where(F.col("is_deleted") == 1)
    dest.delete(flagged.where(F.col("o_orderkey") <= mid).select("o_orderkey"), "first")
    dest.load(d.where(F.col("o_orderkey") > mid), "high")
    back = d.where((F.col("o_orderkey") <= mid) & (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % 10 == 0))
    dest.load(back.withColumn("o_orderpriority", F.lit("back")), "back")
    dest.delete(flagged.where(F.col("o_orderkey") > mid).select("o_orderkey"), "second")
    dest.compact("worn", min_deleted=0.3)
    return dest.read()


def manifest_pruned_load(spark, sf):
    """The incremental load against a destination of several commits, of which only files that can hold an incoming key
    are opened."""
    s, d, mid = src_dst(spark, sf)
    dest, _ = workplace(spark, dest_spec(d, "o_orderkey"), "pruned")
    top = orders(spark, sf).agg(F.max("o_orderkey")).first()[0]
    edges = [None, mid // 2, mid, (mid + top) // 2, None]
    for low, high in zip(edges, edges[1:]):
        part = d if low is None else d.where(F.col("o_orderkey") > low)
        dest.load(part if high is None else part.where(F.col("o_orderkey") <= high), f"upto-{high}")
    new = write_through(s.where(fresh(mid)), "pruned-source")
    return C.accepted(new, "o_orderkey", dest.keys(after=F.col("high") > mid, matching=new.select("o_orderkey")))


def concurrent_commits(spark, sf):
    """Two writers load overlapping thirds at once; the second to commit finds the first's keys, and both deletes count."""
    rows = orders(spark, sf)
    low, high = rows.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    cut = [low + (high - low) * i // 3 for i in (1, 2)]
    dest, _ = workplace(spark, dest_spec(rows, "o_orderkey"), "writers")
    other = DestTable(spark, dest.path, dest.spec)
    parts = (rows.where(F.col("o_orderkey") <= cut[1]), rows.where(F.col("o_orderkey") > cut[0]).withColumn("o_orderpriority", F.lit("second")))
    base = dest.snapshot()
    written = [writer.write(C.classify(part, dest.spec)) for writer, part in zip((dest, other), parts)]
    done = [writer.commit(seq, run, base) for writer, seq, run in zip((dest, other), written, ("one", "two"))]
    for writer, status in ((dest, "F"), (other, "O")):
        writer.delete(rows.where((F.col("o_orderstatus") == status) & (F.col("o_custkey") % 4 == 0)).select("o_orderkey"), f"delete-{status}")
    refused = dest.rejects().where("run_id = 'two'").count()
    if [d.version for d in done] != [1, 2]:
        raise SyncError(f"expected two commits in turn, got {done}")
    return dest.read().withColumn("n_refused", F.lit(refused).cast("long"))


def stream_stateful(spark, sf):
    """Every event is inserted and every error deleted again by one stream, whose state knows the keys; then it is
    started once more from its checkpoint."""
    _, dest, _, job, checkpoint = stream_place(spark, sf, "stream-stateful")
    steps = F.when(F.col("event_type") == "error", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    for _ in range(2):
        stream = event_stream(spark, sf).select(*EVENT_COLUMNS, F.explode(steps).alias("is_deleted"))
        stream_keyed(stream, job, dest, checkpoint, F.col("is_deleted")).awaitTermination()
    return dest.read()


def stream_keyset_source(spark, sf):
    """Orders polled by key into a destination, twice; the second poll finds nothing after the watermark."""
    register_keyset(spark)
    rows = orders(spark, sf)
    dest, store = workplace(spark, dest_spec(rows, "o_orderkey"), "stream-keyset")
    checkpoint = work_path(spark, "stream-keyset-checkpoint")
    for _ in range(2):
        stream = spark.readStream.format("keyset").option("path", f"{sf}/orders.parquet").option("key", "o_orderkey").load()
        stream_inserts(stream, JobSpec("polled", "orders", "dst", "o_orderkey"), dest, store, checkpoint).awaitTermination()
    return dest.read()


# -- reconciliation and pages by rank ---------------------------------------------


def table_difference(spark, sf):
    """Orders against a copy that lacks some, has some too many, and holds some with another price."""
    o = orders(spark, sf)
    copy = o.where(F.col("o_orderkey") % 13 != 0)
    price = F.when(F.col("o_custkey") % 11 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    more = o.where(F.col("o_orderkey") % 17 == 0).withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return table_diff(o, copy.withColumn("o_totalprice", price).unionByName(more), "o_orderkey")


def sketch_profile(spark, sf):
    """Sketches of five runs' keys, merged: counts, and whether the estimates are within their bounds."""
    line = table(spark, sf, "lineitem").select("l_partkey", (F.col("l_orderkey") % 5).alias("run"))
    each = [key_sketch(line.where(F.col("run") == i), "l_partkey") for i in range(5)]
    runs = each[0]
    for one in each[1:]:
        runs = runs.unionByName(one)
    merged = merge_sketches(runs, "bigint")
    profile = profile_of(merged, "bigint", (0.5,)).select("n_rows", "n_distinct", F.col("at_ranks")[0].alias("middle"))
    exact = line.agg(F.count_distinct("l_partkey").alias("true_distinct"))
    row, true = profile.first(), exact.first()[0]
    below = [F.count_if(c) / F.count("*") for c in (F.col("l_partkey") < row["middle"], F.col("l_partkey") <= row["middle"])]
    rank = line.agg(below[0].alias("low"), below[1].alias("high")).first()
    return profile.select(
        F.col("n_rows"), F.lit(abs(row["n_distinct"] - true) <= 0.05 * true).alias("distinct_ok"),
        F.lit(rank["low"] <= 0.52 and rank["high"] >= 0.48).alias("middle_ok"),
    )


def ranked_page_deep(spark, sf):
    """A page far into the longest table, of which the index leaves one range of 32 or two to sort."""
    line = table(spark, sf, "lineitem")
    index = RankIndex.build(line, "l_orderkey", work_path(spark, "ranks"), ranges=32)
    return index.page(line, "l_orderkey", line.count() // 2, BATCH).select("row_no", *LINE_KEY, "l_partkey", "l_suppkey")


def ranked_resume(spark, sf):
    """The next rows after a checkpoint's key, with their places in the whole table."""
    line = table(spark, sf, "lineitem")
    index = RankIndex.build(line, "l_orderkey", work_path(spark, "ranks"), ranges=32)
    return index.resume(line, "l_orderkey", [middle(line, "l_orderkey")], BATCH).select("row_no", *LINE_KEY, "l_partkey", "l_suppkey")


def mixed_names(spark, sf) -> DataFrame:
    """Customers' names, every third in capitals and every fifth with blanks behind."""
    name = F.when(F.col("c_custkey") % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name"))
    name = F.when(F.col("c_custkey") % 5 == 0, F.concat(name, F.lit("  "))).otherwise(name)
    return table(spark, sf, "customer").select("c_custkey", name.alias("c_name"), "c_acctbal")


def collated_pages(spark, sf):
    """A page after a cursor that is written in another case than the key it stands for."""
    names = mixed_names(spark, sf)
    mark = names.where(F.col("c_custkey") == middle(names, "c_custkey")).select(F.upper(F.rtrim("c_name"))).first()[0]
    return paging.keyset_page(names, "c_name", [mark], BATCH, "UTF8_LCASE_RTRIM")


def collated_batches(spark, sf):
    """Batches whose ends are in the order in which keys are equal."""
    return paging.batch_manifest(mixed_names(spark, sf), "c_name", BATCH, collation="UTF8_LCASE_RTRIM")


QUERIES = {
    f.__name__: f
    for f in (
        extract_template, extract_join_query, extract_aggregate_query, extract_projection, query_schema,
        keyset_page, keyset_page_composite, batch_manifest, batch_manifest_composite, keyset_resume,
        offset_page_fallback, jdbc_stripes,
        row_count, deleted_count, key_profile, table_schema, preflight_report, query_validation,
        incremental_extract, delta_deleted_ids,
        type_code_map, type_compat_matrix, schema_compat_report, schema_verdict, dest_pk_validation, pk_choice,
        column_mapping_insert, full_load_accepted, full_load_rejects, incremental_accepted,
        incremental_first_run, incremental_rejects, constraint_rejects, reject_table, classified_load,
        full_load_hot_keys, full_load_joined_hot_keys, multi_unique_rejects, sync_constraints,
        batch_metrics, load_progress, delta_apply, delta_effect,
        watermark_lookup, watermark_upsert, watermark_advance, checkpoint_lookup, checkpoint_upsert,
        checkpoint_complete, state_clear, state_clear_count, delete_log_merge, delete_log_pending,
        delete_log_mark, run_summary, multi_job_state,
        mode_detect, mode_forced, fresh_start,
        sync_full, full_load_resumed, sync_incremental, sync_rejects, sync_batches, sync_history, sync_delta,
        sync_sequence, stream_incremental, stream_late_keys, stream_late_fill, stream_delete,
        sync_without_key, sync_schema_warnings, sync_text_key, sync_collated_key, sync_zone_watermark, sync_delta_bad_key,
        stream_new_checkpoint, stream_delete_new_checkpoint, offset_page_deep, full_load_resumed_text,
        delete_bitmaps, manifest_pruned_load, concurrent_commits,
        stream_stateful, stream_keyset_source, table_difference, sketch_profile, ranked_page_deep, ranked_resume, collated_pages, collated_batches,
    )
}
