"""Queries that exercise loading and streaming jobs.

Each one has Spark write landing files derived from the test tables into a fresh
folder under the shared one, runs the job over them, and returns what the job
stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake import schemas
from storelake.operators import cleaning
from storelake.plans import analytics, dims, facts, gold, iot, rollups
from storelake.session import TIDY, new_folder, settings
from storelake.sources import batches, buckets, landing, tables, testbed
from storelake.streaming import buffer, distinct, ingest, ledger, orders, rollup
from storelake.streaming import stores as store_job

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Landing drops: the lines up to this day arrive first, the later ones second.
FIRST_DROP = "1998-06-30"
EVENTS_PER_FILE = 5000
#: As browsers and tools name folders and files: patterns, or other signs in a URI.
ODD = "drop (1) [2] {a,b} 5%20"
CHANGES_FROM = "1998-01-01"
POS_CSV = {
    "header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"
}


class Job:
    """Test relations as landing files, and fresh folders for what a job stores."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = new_folder(spark, name)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def pos(self) -> DataFrame:
        """Sales lines in the types of the landing schema."""
        return tables.conform(testbed.pos(self.spark, self.sf_dir), schemas.pos_schema())

    @property
    def erp(self) -> DataFrame:
        schema = schemas.erp_orders_schema().add("load_ts", "timestamp_ntz")
        return tables.conform(testbed.erp_orders(self.spark, self.sf_dir), schema)

    def landed(
        self, df: DataFrame, parts: list[Column], dst: str | list[str], csv: bool = False
    ) -> Iterator[str]:
        """The rows of each condition as files in ``dst``, or each in a folder of its own, one
        after another.

        They are stored in one pass, so that what ``df`` is derived from is read and joined once.
        CSV files take several times the bytes, so they are written from the stored rows when
        their turn comes, and the stored rows go.
        """
        folders = [dst] * len(parts) if isinstance(dst, str) else dst
        stored = batches.write_parts(df, parts, new_folder(self.spark, "drops"), "parquet", {})
        for part, folder in zip(stored, folders, strict=True):
            files = part
            if csv:
                files = f"{new_folder(self.spark, 'csv')}/{part.rsplit('/', 1)[-1]}"
                rows = self.spark.read.schema(df.schema).parquet(part)
                rows.write.options(**POS_CSV).csv(files)
                batches.delete(self.spark, part)
            batches.land_files(self.spark, files, folder)
            yield folder

    def drops(self, df: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
        first = F.col(day) <= F.lit(FIRST_DROP).cast("date")
        return df.where(first), df.where(~first)

    def pos_csv(self, df: DataFrame, folder: str) -> str:
        df.write.mode("append").options(**POS_CSV).csv(f"{folder}/pos")
        return folder

    def json_arrays(self) -> str:
        """Files that hold one array of at most EVENTS_PER_FILE documents each."""
        docs = testbed.iot_documents(self.spark, self.sf_dir)
        number = F.col("data.event_id").cast("bigint")
        arrays = docs.groupBy(F.floor(number / EVENTS_PER_FILE)).agg(
            F.collect_list("data").alias("docs")
        )
        texts = arrays.select(testbed.as_json("docs").alias("value"))
        texts.write.option("maxRecordsPerFile", 1).text(self.at("json"))
        return self.at("json")

    def bronze(self, df: DataFrame, name: str) -> str:
        df.write.mode("append").parquet(self.at(name))
        return self.at(name)


def job(name: str):
    def register(fn: Callable[[Job], DataFrame]):
        JOBS[name] = lambda spark, sf_dir: fn(Job(spark, sf_dir, name))
        return fn

    return register


# --- batch loading --------------------------------------------------------------


@job("scan_csv_landing")
def _(j: Job):
    src = j.pos_csv(j.pos, j.at("landing"))
    rows = landing.read_csv_landing(j.spark, f"{src}/pos", schemas.pos_schema(), landing.POS_FILES)
    return rows.select(*schemas.POS_COLUMNS)


@job("scan_parquet_by_name")
def _(j: Job):
    """Two folders, the name of one of which is a pattern that matches the other."""
    shouting = j.erp.select(*[F.col(c).alias(c.upper()) for c in schemas.ERP_ORDER_COLUMNS])
    first, second = j.drops(shouting, "ACTUAL_DELIVERY")
    first.write.parquet(j.at(f"landing/erp_orders/{ODD}"))
    second.write.parquet(j.at(f"landing/erp_orders/{ODD.replace('[2]', '2').replace('{a,b}', 'a')}"))
    return landing.read_parquet_by_name(
        j.spark, j.at("landing"), schemas.erp_orders_schema(), landing.ERP_ORDER_FILES
    )


@job("scan_parquet_as_variant")
def _(j: Job):
    tables.write_table(j.erp, j.at("landing"))
    raw = landing.read_parquet_variant(j.spark, j.at("landing"))
    fields = {f.name: (f.name, f.dataType.simpleString()) for f in schemas.erp_orders_schema()}
    return landing.project_paths(raw, fields, variant="raw_data")


@job("scan_json_array")
def _(j: Job):
    raw = landing.read_json_landing(j.spark, j.json_arrays(), schemas.iot_event_schema(), None)
    return iot.iot_events(raw)


@job("scan_json_array_variant")
def _(j: Job):
    return iot.iot_alerts(landing.read_json_variant(j.spark, j.json_arrays(), None), wide=True)


@job("file_name_pattern")
def _(j: Job):
    first, second = j.drops(j.pos, "transaction_date")
    j.pos_csv(first, j.at("landing/store=1"))
    second.write.option("header", "true").csv(j.at("landing/store=1/returns"))
    rows = landing.read_csv_landing(
        j.spark, j.at("landing/store=1/*"), schemas.pos_schema(), ".*/pos/.*[.]csv"
    )
    return rows.select("transaction_id", "product_sku", "transaction_date", "quantity")


@job("load_metadata")
def _(j: Job):
    src = j.pos_csv(j.pos, j.at("landing"))
    rows = landing.read_csv_landing(j.spark, f"{src}/pos", schemas.pos_schema())
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("source_file").rlike(landing.POS_FILES)).alias("n_with_file"),
        F.countDistinct("load_ts").alias("n_load_times"),
    )


@job("external_csv_positional")
def _(j: Job):
    src = j.pos_csv(j.pos, j.at("landing"))
    return landing.read_csv_positional(j.spark, f"{src}/pos", landing.EXTERNAL_POS)


@job("external_by_name")
def _(j: Job):
    stored = tables.write_table(j.erp, j.at("landing"))
    return landing.project_paths(stored, landing.EXTERNAL_ERP_ORDERS)


@job("external_iot_events")
def _(j: Job):
    raw = landing.read_json_variant(j.spark, j.json_arrays(), None)
    return iot.external_events(raw)


@job("external_inventory_by_name")
def _(j: Job):
    stored = tables.write_table(testbed.inventory(j.spark, j.sf_dir), j.at("landing"))
    return landing.project_paths(stored, landing.EXTERNAL_ERP_INVENTORY)


@job("ctas_snapshot")
def _(j: Job):
    report = facts.daily_sales_report(testbed.pos(j.spark, j.sf_dir))
    return tables.write_table(report, j.at("snapshot"))


@job("insert_select")
def _(j: Job):
    stock = testbed.inventory(j.spark, j.sf_dir)
    low = F.col("quantity_on_hand") < 10
    schema = schemas.erp_inventory_schema()
    tables.append_table(stock.where(low).drop("last_received_date"), j.at("stock"), schema)
    return tables.append_table(
        stock.where(~low).drop("reorder_level"), j.at("stock"), schema, {"reorder_level": 5}
    )


@job("truncate_reload")
def _(j: Job):
    """Loads a fact by year, then reloads the later years only."""
    sales = facts.sales_buffer(testbed.pos(j.spark, j.sf_dir)).withColumn("year", F.year("date_key"))
    doubled = sales.withColumn("total_quantity", F.col("total_quantity") * 2)
    tables.write_table(doubled, j.at("fact"), partition_by=["year"])
    reload = sales.where(F.col("year") >= F.year(F.lit(FIRST_DROP)))
    return tables.write_table(reload, j.at("fact"), partition_by=["year"])


@job("as_of_read")
def _(j: Job):
    stored = tables.write_table(j.erp, j.at("orders"))
    past = tables.as_of(stored, "load_ts", f"{FIRST_DROP} 00:00:00")
    return past.select("order_id", "product_sku", "order_status", "load_ts")


# --- streams --------------------------------------------------------------------


def _ingest_pos(j: Job) -> str:
    """Two runs of the landing stream, one drop each, and a third that finds nothing."""
    schema = schemas.pos_schema()
    src, first = j.at("landing"), F.col("transaction_date") <= F.lit(FIRST_DROP).cast("date")
    for _drop in j.landed(j.pos, [first, ~first], f"{src}/pos", csv=True):
        ingest.ingest_stream(
            j.spark, src, "csv", schema, j.at("bronze"), j.at("ckpt"), landing.POS_FILES
        ).awaitTermination()
    idle = ingest.ingest_stream(
        j.spark, src, "csv", schema, j.at("bronze"), j.at("ckpt"), landing.POS_FILES
    )
    idle.awaitTermination()
    batches.delete(j.spark, src)  # all of it is in bronze, and no later step reads it
    return j.at("bronze")


@job("incremental_ingest")
def _(j: Job):
    return ingest.read_bronze(j.spark, _ingest_pos(j), schemas.pos_schema()).select(
        *schemas.POS_COLUMNS
    )


def _ingest_erp(j: Job, name: str, df: DataFrame, schema, whole: list[str]) -> DataFrame:
    """Three runs: whole numbers as int, as bigint under upper-case names, and as text with
    one bad row, beside files of another feed in the same folder."""
    src, columns = j.at("landing"), schema.names
    half = F.pmod(F.xxhash64(*columns[:3]), F.lit(2)) == 0
    wide = [F.col(c).cast("bigint" if c in whole else df.schema[c].dataType) for c in columns]
    text = [F.col(c).cast("string") if c in whole else F.col(c) for c in columns]
    df.select(*columns).where(half).write.parquet(f"{src}/{name}/a")
    drops = [df.where(~half).select(*[c.alias(n.upper()) for c, n in zip(wide, columns, strict=True)])]
    bad = df.select(*columns).limit(1).withColumn(whole[0], F.lit("many"))
    drops.append(bad.select(*columns))
    df.limit(0).select(*text).withColumn(columns[0], F.lit(1.5)).write.parquet(f"{src}/other_feed")
    for n in range(3):
        if n:
            drops[n - 1].write.parquet(f"{src}/{name}/{ODD}{n}")
        ingest.ingest_stream(
            j.spark, src, "parquet", schema, j.at("bronze"), j.at("ckpt"), f".*/{name}/.*[.]parquet"
        ).awaitTermination()
    loaded = ingest.read_bronze(j.spark, j.at("bronze"), schema).select(*columns)
    n_bad = ingest.read_rejects(j.spark, j.at("bronze"), schema).select(F.count("*")).scalar()
    return loaded.withColumn("rows_rejected", n_bad)


@job("ingest_erp_orders")
def _(j: Job):
    schema = schemas.erp_orders_schema()
    whole = ["quantity_ordered", "quantity_received"]
    # the base tables are joined once
    lines = tables.write_table(tables.conform(j.erp, schema), j.at("lines"))
    return _ingest_erp(j, "erp_orders", lines, schema, whole)


@job("ingest_erp_inventory")
def _(j: Job):
    schema = schemas.erp_inventory_schema()
    stock = tables.conform(testbed.inventory(j.spark, j.sf_dir), schema)
    return _ingest_erp(j, "erp_inventory", stock, schema, ["quantity_on_hand", "reorder_level"])


@job("ingest_iot")
def _(j: Job):
    """Arrays of documents, and one file whose second element has a text for a number."""
    src = j.json_arrays()
    good = '{"event_id": null, "store_id": "none"}'
    bad = '{"event_id": "x", "metadata": {"battery_pct": "low"}}'
    extra = j.spark.createDataFrame([(f"[{good}, {bad}]",)], "value string")
    extra.write.text(f"{src}/{ODD}")
    ingest.ingest_stream(
        j.spark, src, "json", schemas.iot_event_schema(), j.at("bronze"), j.at("ckpt")
    ).awaitTermination()
    schema = schemas.iot_event_schema()
    loaded = ingest.read_bronze(j.spark, j.at("bronze"), schema, "json")
    n_bad = ingest.read_rejects(j.spark, j.at("bronze"), schema, "json").select(F.count("*")).scalar()
    return iot.iot_events(loaded).where("event_id is not null").withColumn("rows_rejected", n_bad)


@job("append_only_stream")
def _(j: Job):
    bronze = _ingest_pos(j)
    ingest.stream_append(
        j.spark, bronze, ingest.bronze_schema(schemas.pos_schema()), j.at("silver"),
        j.at("silver_ckpt"), ingest.pos_to_silver,
    ).awaitTermination()
    return j.spark.read.parquet(j.at("silver")).drop("processed_ts")


def _ledger(j: Job) -> DataFrame:
    """Loads both drops, then reads all files again from a fresh checkpoint."""

    def load(ckpt: str) -> None:
        ledger.ingest_with_ledger(
            j.spark, j.at("landing"), "csv", schemas.pos_schema(), "pos_transactions",
            j.at("bronze"), j.at("ledger"), j.at(ckpt), landing.POS_FILES,
        ).awaitTermination()

    first = F.col("transaction_date") <= F.lit(FIRST_DROP).cast("date")
    folders = [j.at("landing/pos"), j.at(f"landing/{ODD}/pos")]
    for _drop in j.landed(j.pos, [first, ~first], folders, csv=True):
        load("first")
    load("second")
    return ledger.read_ledger(j.spark, j.at("ledger"))


@job("file_ledger")
def _(j: Job):
    """Files of the landing folder that the ledger lacks or counts twice: none; and all rows."""
    rows = _ledger(j)
    listed = landing.list_files(j.spark, j.at("landing"), landing.POS_FILES)
    entries = rows.groupBy("source_file").agg(
        F.count("*").alias("entries"),
        F.sum("rows_loaded").alias("loaded"),
        F.sum("rows_rejected").alias("rejected"),
    )
    return listed.join(entries, F.col("file_id") == F.col("source_file"), "full_outer").agg(
        F.count_if(F.col("entries").isNull() & (F.col("file_bytes") > 0)).alias("files_missing"),
        F.count_if(F.col("entries") > 1).alias("files_twice"),
        F.sum("loaded").alias("rows_loaded"),
        F.sum("rejected").alias("rows_rejected"),
    )


@job("load_audit")
def _(j: Job):
    audit = ledger.load_audit(_ledger(j), "2000-01-01 00:00:00")
    # How many files Spark writes is its own affair: what counts is that none is over.
    listed = landing.list_files(j.spark, j.at("landing"), landing.POS_FILES)
    n = listed.select(F.count("*")).scalar()
    return audit.select(
        "table_name", (F.col("n_files") - n).alias("files_over"), "rows_loaded", "rows_rejected"
    )


@job("run_if_data")
def _(j: Job):
    """Rows of a table whose stream ran once with data and twice without."""
    bronze = j.bronze(testbed.inventory(j.spark, j.sf_dir), "bronze")
    for _run in range(3):
        ingest.stream_append(
            j.spark, bronze, schemas.erp_inventory_schema(), j.at("copy"), j.at("ckpt")
        ).awaitTermination()
    return j.spark.read.parquet(j.at("copy")).agg(F.count("*").alias("n_rows"))


@job("inventory_append")
def _(j: Job):
    bronze = j.bronze(testbed.inventory(j.spark, j.sf_dir), "bronze")
    ingest.stream_append(
        j.spark, bronze, schemas.erp_inventory_schema(), j.at("silver"), j.at("ckpt"),
        ingest.inventory_to_silver,
    ).awaitTermination()
    return j.spark.read.parquet(j.at("silver")).drop("processed_ts")


@job("iot_passthrough")
def _(j: Job):
    docs = testbed.iot_documents(j.spark, j.sf_dir)
    bronze = j.bronze(docs, "bronze")
    ingest.stream_append(
        j.spark, bronze, docs.schema, j.at("silver"), j.at("ckpt"), ingest.iot_to_silver
    ).awaitTermination()
    return iot.iot_events(j.spark.read.parquet(j.at("silver")))


@job("stream_insert_all")
def _(j: Job):
    schema = j.erp.schema
    for drop in j.drops(j.erp, "actual_delivery"):
        bronze = j.bronze(drop, "bronze")
        ingest.stream_append(
            j.spark, bronze, schema, j.at("copy"), j.at("ckpt")
        ).awaitTermination()
    return j.spark.read.parquet(j.at("copy"))


@job("chained_refresh")
def _(j: Job):
    """Two drops split by quantity, so that the second touches days of the first."""
    few = F.col("quantity") <= 25
    for bronze in j.landed(j.pos, [few, ~few], j.at("bronze")):
        buffer.sales_buffer_stream(
            j.spark, bronze, schemas.pos_schema(), j.at("silver"), j.at("buffer"), j.at("ckpt"),
            grain="year",
        ).awaitTermination()
    return j.spark.read.parquet(j.at("buffer")).drop(tables.PERIOD)


@job("merge_orders_stream")
def _(j: Job):
    """Order lines in two batches, the second one updating orders of the first."""
    return orders.read_orders(j.spark, _merge_orders(j, 2), j.erp.schema)


@job("orders_as_of")
def _(j: Job):
    """The orders as they stood between the two batches, from a base that is not the newest."""
    root = _merge_orders(j, 1)
    commits = batches.read_batches(j.spark, f"{root}/commits", orders.COMMITS)
    first = commits.where("batch = 0").select(F.col("committed_at").cast("string")).scalar()
    moment = j.spark.range(1).select(first).first()[0]
    return orders.read_orders_as_of(j.spark, root, j.erp.schema, moment)


@job("orders_change_feed")
def _(j: Job):
    """What the second batch changed, between two stored versions; equal buckets stay closed."""
    root = _merge_orders(j, 1)
    return buckets.changes_between(j.spark, root, j.erp.schema, orders.ORDER_KEYS, 0, 1)


def _merge_orders(j: Job, compact_every: int) -> str:
    early = F.col("load_ts") < F.lit(CHANGES_FROM).cast("timestamp_ntz")
    erp = j.erp
    for bronze in j.landed(erp, [early, ~early], j.at("bronze")):
        orders.orders_stream(
            j.spark, bronze, erp.schema, j.at("orders"), j.at("ckpt"), compact_every=compact_every,
            buckets=16,
        ).awaitTermination()
    return j.at("orders")


@job("scd2_stream")
def _(j: Job):
    """The store dimension after two drops of updates: first load, then moves and new stores."""
    stores = dims.dim_store(testbed.pos(j.spark, j.sf_dir))
    moved = F.when(F.col("store_region") == "ASIA", F.col("store_region"))
    drops = (
        (stores.where(F.col("store_region") != "EUROPE"), F.col("store_city"), "1996-01-01"),
        (stores, F.coalesce(moved, F.col("store_city")), "1999-01-01"),
    )
    for rows, city, day in drops:
        at = F.lit(f"{day} 08:00:00").cast("timestamp_ntz").alias("load_ts")
        feed = rows.select("store_id", "store_name", city.alias("store_city"), at)
        src = j.bronze(feed, "updates")
        store_job.store_history_stream(
            j.spark, src, feed.schema, j.at("stores"), j.at("ckpt")
        ).awaitTermination()
    return store_job.read_store_history(j.spark, j.at("stores"))


@job("incremental_rollup")
def _(j: Job):
    """Exact columns of a store-day rollup built from two batches."""
    lines = testbed.pos(j.spark, j.sf_dir)
    few = F.col("quantity") <= 25
    for drop in (lines.where(few), lines.where(~few)):
        bronze = j.bronze(drop, "bronze")
        rollup.maintain_rollup(
            j.spark, bronze, lines.schema, rollup.STORE_DAY, j.at("rollup"), j.at("ckpt"),
            compact_every=2,
        ).awaitTermination()
    kept = rollup.read_rollup(j.spark, j.at("rollup"), lines.schema, rollup.STORE_DAY)
    return kept.drop("approx_txns", "approx_customers")


@job("incremental_rollup_distinct")
def _(j: Job):
    """How far the distinct-count estimates are from the exact counts: within five percent."""
    lines = testbed.pos(j.spark, j.sf_dir)
    bronze = j.bronze(lines, "bronze")
    keys = rollup.CATEGORY_REGION
    rollup.maintain_rollup(
        j.spark, bronze, lines.schema, keys, j.at("rollup"), j.at("ckpt")
    ).awaitTermination()
    kept = rollup.read_rollup(j.spark, j.at("rollup"), lines.schema, keys)
    exact = facts.sales_lines(lines).groupBy(*keys).agg(
        F.countDistinct("transaction_id").alias("txns"),
        F.countDistinct("customer_id").alias("customers"),
    )

    def close(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= F.col(count) * 0.05

    return kept.join(exact, keys).select(
        *keys, "txns", "customers",
        (close("approx_txns", "txns") & close("approx_customers", "customers")).alias("close"),
    )


@job("incremental_margin_store")
def _(j: Job):
    """Margins by store after two batches of sales and two of purchases, in turn."""
    few, early = F.col("quantity") <= 25, F.col("load_ts") < F.lit(CHANGES_FROM).cast("timestamp_ntz")
    lines, erp = testbed.pos(j.spark, j.sf_dir), j.erp
    drops = ((lines.where(few), erp.where(~early)), (lines.where(~few), erp.where(early)))
    for sold, bought in drops:
        for rows, kind, name in (
            (sold, rollup.MARGIN_SALES, "sales"), (bought, rollup.MARGIN_COSTS, "costs")
        ):
            rollup.maintain(
                j.spark, j.bronze(rows, f"{name}_bronze"), rows.schema, kind, j.at(name),
                j.at(f"{name}_ckpt"), compact_every=2,
            ).awaitTermination()
    return rollup.read_margin_store(j.spark, j.at("sales"), lines.schema, j.at("costs"), erp.schema)


@job("incremental_erp_category")
def _(j: Job):
    """Purchase cost per category from variant rows in three batches."""
    raw = testbed.erp_raw(j.spark, j.sf_dir)
    third = F.pmod(F.xxhash64(F.variant_get("raw_data", "$.order_id", "string")), F.lit(3))
    for bronze in j.landed(raw, [third == n for n in range(3)], j.at("bronze")):
        rollup.maintain(
            j.spark, bronze, raw.schema, rollup.CATEGORY_COST, j.at("costs"),
            j.at("ckpt"), compact_every=2,
        ).awaitTermination()
    return rollup.read_erp_category(j.spark, j.at("costs"), raw.schema)


@job("repeated_deliveries")
def _(j: Job):
    """Sales lines delivered again within the delay of two hours, after it, and too late.

    Stored are the first arrivals, lines that come again when they are forgotten, and
    nothing of the last drop, which is older than the watermark.
    """
    with settings(j.spark, TIDY):
        lines = tables.write_table(j.pos, j.at("lines"))  # the base tables are joined once
    part = F.col("transaction_id").cast("bigint") % 4
    drops = (
        ("08:00", part < 2),  # half of the lines
        ("09:00", (part == 1) | (part == 2)),  # a quarter again, a quarter new
        ("14:00", part == 3),  # the last quarter; the first two drops are forgotten
        ("15:00", part == 1),  # again, and taken again
        ("09:30", part == 0),  # before the watermark of 13:00
    )
    late = 0
    for at, which in drops:
        stamped = lines.where(which).withColumn("load_ts", F.lit(f"2024-01-01 {at}:00").cast("timestamp_ntz"))
        query = distinct.append_distinct(
            j.spark, j.bronze(stamped, "bronze"), stamped.schema, j.at("silver"), j.at("ckpt"),
            schemas.POS_COLUMNS,
        )
        query.awaitTermination()
        batches.delete(j.spark, j.at("bronze"))  # the stream has taken the drop
        late += distinct.late_rows(query)
    return j.spark.read.parquet(j.at("silver")).select("*", F.lit(late).cast("long").alias("rows_late"))


def _gold(j: Job) -> dict[str, DataFrame]:
    """The gold tables from lines stored with the columns that they use: derived once."""
    pos, erp = testbed.pos(j.spark, j.sf_dir), testbed.erp_orders(j.spark, j.sf_dir)
    lines = tables.side_by_side(
        {
            "pos": lambda: tables.write_table(pos.select(*gold.POS_NEEDS), j.at("lines/pos")),
            "erp": lambda: tables.write_table(erp.select(*gold.ERP_NEEDS), j.at("lines/erp")),
        }
    )
    readings = testbed.iot_readings(j.spark, j.sf_dir)
    return gold.build_gold(lines["pos"], lines["erp"], readings, j.at("gold"), grain="year")


@job("gold_tables")
def _(j: Job):
    """Row counts of all gold tables, built from the sources and then read as stored."""
    stored = _gold(j)
    return cleaning.layer_row_counts(gold.labelled(stored))


@job("gold_sales_vs_iot")
def _(j: Job):
    """Stored values, not counts: the fact that is built from two other stored facts."""
    stored = _gold(j)
    return stored["fct_sales_vs_iot"].drop(tables.PERIOD)


@job("gold_store_q4")
def _(j: Job):
    """A quarter of the stored store-days, from the partitions of that year only."""
    days = rollups.store_daily(facts.fct_daily_sales(testbed.pos(j.spark, j.sf_dir)))
    stored = gold.store_by_period(days, j.at("store_days"), "report_date", "year")
    return analytics.store_period(stored, "1998-10-01", "1998-12-31")


@job("load_clock")
def _(j: Job):
    """Rows stamped with an injected time, and with the clock."""
    at = "2024-01-01 00:00:00"
    rows = cleaning.stamp(testbed.inventory(j.spark, j.sf_dir), at=at)
    rows = cleaning.stamp(rows, name="clock_ts")
    return rows.agg(
        F.count_if(F.col("processed_ts") == F.lit(at).cast("timestamp_ntz")).alias("n_injected"),
        F.count_if(F.col("clock_ts") > F.col("processed_ts")).alias("n_clock"),
    )
