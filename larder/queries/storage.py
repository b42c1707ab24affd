"""Sources, sinks and the catalog, by round trip through shared storage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from ..errors import QualityError, WriteError
from ..functions.columns import money_sum
from ..operators.joins import equi_join, join_dimension
from ..operators.quality import enforce, min_rows, no_nulls
from ..operators.tuning import fewer_partitions, kept, spread_by
from ..operators.windows import with_group_stats
from ..plans.jobs import kpi_job
from ..session import scratch_path, stash, union_all
from ..sources.catalog import (
    cached_table, create_bucketed_table, create_database, create_table, create_view, list_partitions, list_tables,
    shared_view, views_of,
)
from ..sources.publish import publish, publish_partitions, read_published
from ..sources.readers import read_in_order, read_source
from ..sources.writers import deliver_formats, deliver_frames, export_partitions, write_sink, write_sized
from .registry import RESTAURANTS, TICKETS, query, restaurants, sql_money, tickets


@contextmanager
def _database(spark):
    """A database of its own in the shared folder, so runs do not meet; dropped with its tables."""
    name = create_database(spark, f"larder_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database"))
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def _round_trip(kind):
    def run(spark, sf_dir):
        """Written and read back; the schema is given, not inferred."""
        lines = tickets(spark, sf_dir)
        path = write_sink(lines, kind, f"{scratch_path(spark, kind)}/tickets")
        return read_in_order(spark, path, lines.schema, kind)

    return run


for _kind in ("parquet", "csv", "json", "orc"):
    query(f"roundtrip_{_kind}", f"WITH {TICKETS} SELECT * FROM tickets")(_round_trip(_kind))


@query("roundtrip_partitioned", f"""
WITH {TICKETS}
SELECT order_id, line, amount, CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month
FROM tickets WHERE YEAR(order_date) = 1998 AND MONTH(order_date) = 1""")
def roundtrip_partitioned(spark, sf_dir):
    """Directories per year and month; the filter reads one of them."""
    dated = tickets(spark, sf_dir).select(
        "order_id", "line", "amount", F.year("order_date").alias("year"), F.month("order_date").alias("month")
    )
    path = write_sink(dated, "parquet", f"{scratch_path(spark, 'dated')}/tickets", partition_by=["year", "month"])
    return read_in_order(spark, path, dated.schema).filter((F.col("year") == 1998) & (F.col("month") == 1))


@query("roundtrip_partitioned_all", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month, COUNT(*) AS orders,
       {sql_money("amount")} AS revenue FROM tickets GROUP BY 1, 2""")
def roundtrip_partitioned_all(spark, sf_dir):
    """Every directory of the partitioned write, read back."""
    dated = tickets(spark, sf_dir).select(
        "order_id", "line", "amount", F.year("order_date").alias("year"), F.month("order_date").alias("month")
    )
    path = write_sink(dated, "parquet", f"{scratch_path(spark, 'dated')}/tickets", partition_by=["year", "month"])
    grouped = read_in_order(spark, path, dated.schema).groupBy("year", "month")
    return grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))


@query("incremental_partitions", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, COUNT(*) AS orders,
       CAST(SUM(CAST(CASE WHEN YEAR(order_date) = 1999 THEN 2 * amount ELSE amount END AS DECIMAL(12,2))) AS DOUBLE)
       AS revenue FROM tickets GROUP BY 1""")
def incremental_partitions(spark, sf_dir):
    """A corrected year replaces its own partition and no other."""
    dated = tickets(spark, sf_dir).select("order_id", "amount", F.year("order_date").alias("year"))
    path = f"{scratch_path(spark, 'incremental')}/tickets"
    export_partitions(dated, path, ["year"])
    export_partitions(dated.filter("year = 1999").withColumn("amount", F.col("amount") * 2), path, ["year"])
    grouped = read_in_order(spark, path, dated.schema).groupBy("year")
    return grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))


@query("save_modes", f"""
WITH {RESTAURANTS}, n AS (SELECT COUNT(*) AS n FROM restaurants)
SELECT 'overwrite' AS mode, n AS rows, false AS refused FROM n UNION ALL SELECT 'append', 2 * n, false FROM n UNION ALL
SELECT 'ignore', n, false FROM n UNION ALL SELECT 'errorifexists', n, true FROM n""")
def save_modes(spark, sf_dir):
    """A second write in each mode onto a path that already holds the rows."""
    places = restaurants(spark, sf_dir)
    base, results = scratch_path(spark, "modes"), []
    for mode in ("overwrite", "append", "ignore", "errorifexists"):
        path = write_sink(places, "parquet", f"{base}/{mode}")
        try:
            write_sink(places, "parquet", path, mode=mode)
            refused = False
        except WriteError:
            refused = True
        written = read_source(spark, "parquet", path, schema=places.schema)
        results.append(
            written.agg(F.lit(mode).alias("mode"), F.count("*").alias("rows"), F.lit(refused).alias("refused"))
        )
    return union_all(results)


@query("compression", f"""
WITH {TICKETS}
SELECT codec, (SELECT COUNT(*) FROM tickets) AS orders, (SELECT {sql_money("amount")} FROM tickets) AS revenue
FROM (VALUES ('snappy'), ('gzip'), ('zstd')) codecs(codec)""")
def compression(spark, sf_dir):
    lines = tickets(spark, sf_dir)
    base, results = scratch_path(spark, "codecs"), []
    for codec in ("snappy", "gzip", "zstd"):
        path = write_sink(lines, "parquet", f"{base}/{codec}", compression=codec)
        results.append(
            read_source(spark, "parquet", path, schema=lines.schema).agg(
                F.lit(codec).alias("codec"), F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue")
            )
        )
    return union_all(results)


@query("multi_format_delivery", f"""
WITH {RESTAURANTS}, kpi AS (SELECT cuisine_type, COUNT(*) AS total, MAX(average_rating) AS best FROM restaurants GROUP BY 1)
SELECT kind, kpi.* FROM kpi, (VALUES ('csv'), ('json'), ('orc'), ('parquet')) kinds(kind)""")
def multi_format_delivery(spark, sf_dir):
    grouped = restaurants(spark, sf_dir).groupBy("cuisine_type")
    kpi = grouped.agg(F.count("*").alias("total"), F.max("average_rating").alias("best"))
    paths = deliver_formats(kpi, scratch_path(spark, "formats"), ("csv", "json", "orc", "parquet"))
    return union_all(
        [
            read_in_order(spark, path, kpi.schema, kind).select(F.lit(kind).alias("kind"), "*")
            for kind, path in paths.items()
        ]
    )


@query("multi_frame_delivery", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT 'restaurants' AS frame, restaurant_id AS id, name AS label, average_rating AS amount FROM restaurants UNION ALL
SELECT 'tickets', order_id, CAST(line AS VARCHAR) || '/' || CAST(restaurant_id AS VARCHAR), amount FROM tickets""")
def multi_frame_delivery(spark, sf_dir):
    """Each frame keeps its own folder; all their rows are read back."""
    frames = {"restaurants": restaurants(spark, sf_dir), "tickets": tickets(spark, sf_dir)}
    paths = deliver_frames(frames, scratch_path(spark, "frames"))
    read = {name: read_source(spark, "parquet", paths[name], schema=df.schema) for name, df in frames.items()}
    labels = {
        "restaurants": ("restaurant_id", F.col("name"), "average_rating"),
        "tickets": ("order_id", F.concat_ws("/", F.col("line").cast("string"), F.col("restaurant_id").cast("string")), "amount"),
    }
    return union_all(
        [
            read[name].select(F.lit(name).alias("frame"), F.col(key).alias("id"), label.alias("label"), F.col(amount).alias("amount"))
            for name, (key, label, amount) in labels.items()
        ]
    )


@query("file_sizing", f"""
WITH {TICKETS} SELECT COUNT(*) AS rows, true AS few_files, true AS records_bounded FROM tickets""")
def file_sizing(spark, sf_dir, share: int = 7):
    """Few files for a small report; a bounded number of rows per file for a large frame."""
    base, lines = scratch_path(spark, "files"), tickets(spark, sf_dir)
    report = lines.groupBy(F.year("order_date").alias("year")).agg(F.count("*").alias("orders"))
    few = write_sink(report, "parquet", f"{base}/few", files=2)
    most = lines.count() // share + 1
    capped = write_sink(lines, "parquet", f"{base}/capped", max_records=most)
    sizes = {
        name: read_source(spark, "parquet", path).select(F.input_file_name().alias("file")).groupBy("file").count()
        for name, path in (("few", few), ("capped", capped))
    }
    return sizes["capped"].agg(
        F.sum("count").alias("rows"),
        F.lit(sizes["few"].count() <= 2).alias("few_files"),
        ((F.max("count") <= most) & (F.count("*") >= share)).alias("records_bounded"),
    )


@query("file_bytes", f"""
WITH {TICKETS} SELECT COUNT(*) AS rows, {sql_money("amount")} AS revenue, true AS in_bounds FROM tickets""")
def file_bytes(spark, sf_dir, least: int = 64 << 10, most: int = 1 << 20):
    """Files between two sizes in bytes, whatever the number of rows."""
    lines, path = tickets(spark, sf_dir), f"{scratch_path(spark, 'sized')}/tickets"
    sizes = write_sized(lines, "parquet", path, least=least, most=most)
    bounded = all(size <= most for size in sizes) and (len(sizes) == 1 or all(size >= least for size in sizes))
    back = read_source(spark, "parquet", path, schema=lines.schema)
    return back.agg(F.count("*").alias("rows"), money_sum(F.col("amount")).alias("revenue"), F.lit(bounded).alias("in_bounds"))


@query("pruned_join", f"""
WITH {TICKETS}, dated AS (SELECT *, CAST(100 * YEAR(order_date) + MONTH(order_date) AS INTEGER) AS month FROM tickets),
months AS (SELECT month, COUNT(*) = MAX(COUNT(*)) OVER (PARTITION BY month // 100) AS busiest FROM dated GROUP BY month)
SELECT month, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM dated JOIN months USING (month) WHERE busiest GROUP BY month""")
def pruned_join(spark, sf_dir):
    """The busiest month of each year, whose directories alone are read: which they are is known at run time only.

    One partition column: of several, each would be pruned by its own values, not by their combinations.
    """
    month = (100 * F.year("order_date") + F.month("order_date")).alias("month")
    dated = tickets(spark, sf_dir).select("order_id", "line", "amount", month)
    path = write_sink(dated, "parquet", f"{scratch_path(spark, 'dated')}/tickets", partition_by=["month"])
    lines = read_in_order(spark, path, dated.schema)
    counts = lines.groupBy("month").agg(F.count("*").alias("n")).withColumn("year", F.expr("month div 100"))
    # One row for each month.
    months = stash(with_group_stats(counts, "year", {"most": F.max("n")}), "months")
    grouped = join_dimension(lines, months.filter("n = most").select("month"), "month").groupBy("month")
    return grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue"))


@query("one_step_publication", f"""
WITH {TICKETS}, years AS (SELECT CAST(YEAR(order_date) AS INTEGER) AS year, COUNT(*) AS orders, {sql_money("amount")} AS revenue
                          FROM tickets GROUP BY 1), states AS (
  SELECT 'first' AS state, * FROM years UNION ALL SELECT 'after a failed job', * FROM years UNION ALL
  SELECT 'corrected year', year, orders, CASE WHEN year = 1999 THEN 2 * revenue ELSE revenue END FROM years)
SELECT * FROM states""")
def one_step_publication(spark, sf_dir):
    """What readers see: after a first job, after one that fails its check, after one that replaces a partition."""
    totals = tickets(spark, sf_dir).groupBy(F.year("order_date").alias("year")).agg(
        F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue")
    )
    path, seen = f"{scratch_path(spark, 'published')}/years", {}
    publish(totals, path, partition_by=["year"], check=lambda df: enforce(df, min_rows(1), "years"))
    seen["first"] = read_published(spark, path)
    try:
        publish(totals.withColumn("orders", F.lit(None).cast("bigint")), path, partition_by=["year"],
                check=lambda df: enforce(df, no_nulls("orders"), "years"))
    except QualityError:
        seen["after a failed job"] = read_published(spark, path)
    publish_partitions(totals.filter("year = 1999").withColumn("revenue", F.col("revenue") * 2), path, ["year"])
    seen["corrected year"] = read_published(spark, path)
    return union_all([df.select(F.lit(state).alias("state"), "year", "orders", "revenue") for state, df in seen.items()])


@query("kpi_delivery", f"""
WITH {RESTAURANTS}
SELECT cuisine_type, COUNT(*) AS total, ROUND(CAST(SUM(CAST(average_rating AS DECIMAL(12,2))) AS DOUBLE) / COUNT(*), 2)
       AS avg_rating, MAX(average_rating) AS best_rating FROM restaurants GROUP BY cuisine_type""")
def kpi_delivery(spark, sf_dir):
    return read_source(spark, "parquet", kpi_job(restaurants(spark, sf_dir), f"{scratch_path(spark, 'kpi')}/kpi"))


# --- catalog ---------------------------------------------------------------------


@query("catalog_ctas", f"WITH {RESTAURANTS} SELECT * FROM restaurants")
def catalog_ctas(spark, sf_dir):
    with _database(spark) as database:
        created = create_table(restaurants(spark, sf_dir), database, "restaurants")
        return stash(read_source(spark, "table", created))


@query("catalog_partitioned", f"""
WITH {RESTAURANTS} SELECT DISTINCT 'city=' || city AS "partition" FROM restaurants""")
def catalog_partitioned(spark, sf_dir):
    with _database(spark) as database:
        created = create_table(restaurants(spark, sf_dir), database, "restaurants", partition_by=["city"])
        return stash(list_partitions(spark, created))


@query("catalog_partition_scan", f"""
WITH {RESTAURANTS} SELECT restaurant_id, name, city FROM restaurants WHERE city = 'MEDIUM'""")
def catalog_partition_scan(spark, sf_dir):
    with _database(spark) as database:
        created = create_table(restaurants(spark, sf_dir), database, "restaurants", partition_by=["city"])
        return stash(spark.table(created).filter(F.col("city") == "MEDIUM").select("restaurant_id", "name", "city"))


@query("catalog_list", """
WITH tables(table_name) AS (VALUES ('restaurants'), ('restaurants_by_city'))
SELECT table_name, false AS temporary FROM tables WHERE (SELECT COUNT(*) FROM part) > 0""")
def catalog_list(spark, sf_dir):
    places = restaurants(spark, sf_dir)
    with _database(spark) as database:
        create_table(places, database, "restaurants")
        create_table(places, database, "restaurants_by_city", partition_by=["city"])
        listed = list_tables(spark, database).filter(F.col("namespace") == database)
        return stash(listed.select(F.col("tableName").alias("table_name"), F.col("isTemporary").alias("temporary")))


@query("views", f"""
WITH {RESTAURANTS}
SELECT city, COUNT(*) AS total FROM restaurants WHERE average_rating >= 950 GROUP BY city""")
def views(spark, sf_dir):
    """A view on a view, both from SQL."""
    good = "SELECT * FROM raw_places WHERE average_rating >= 950"
    with views_of(spark, raw_places=restaurants(spark, sf_dir), good_places=good):
        return spark.sql("SELECT city, COUNT(*) AS total FROM good_places GROUP BY city")


@query("permanent_view", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, COUNT(*) AS orders FROM tickets GROUP BY 1""")
def permanent_view(spark, sf_dir):
    """Stored in the catalog over a stored table, so other sessions can read it."""
    with _database(spark) as database:
        source = create_table(tickets(spark, sf_dir).select("order_id", "order_date"), database, "tickets")
        name = f"{database}.tickets_with_time"
        create_view(spark, name, f"SELECT *, YEAR(order_date) AS year FROM {source}", temporary=False)
        return stash(spark.sql(f"SELECT year, COUNT(*) AS orders FROM {name} GROUP BY year"))


@query("global_view", f"WITH {RESTAURANTS} SELECT cuisine_type, COUNT(*) AS total FROM restaurants GROUP BY cuisine_type")
def global_view(spark, sf_dir):
    with shared_view(restaurants(spark, sf_dir), "shared_places") as name:
        return spark.newSession().sql(f"SELECT cuisine_type, COUNT(*) AS total FROM {name} GROUP BY cuisine_type")


@query("cache_sql", f"""
WITH {RESTAURANTS}
SELECT city, COUNT(*) AS total, MAX(average_rating) AS best,
       (SELECT COUNT(DISTINCT cuisine_type) FROM restaurants) AS cuisines FROM restaurants GROUP BY city""")
def cache_sql(spark, sf_dir):
    """Two queries read the cached view before it is released."""
    with views_of(spark, cached_places=restaurants(spark, sf_dir)), cached_table(spark, "cached_places"):
        cuisines = spark.sql("SELECT COUNT(DISTINCT cuisine_type) AS n FROM cached_places").first()["n"]
        by_city = stash(
            spark.sql("SELECT city, COUNT(*) AS total, MAX(average_rating) AS best FROM cached_places GROUP BY city")
        )
    return by_city.withColumn("cuisines", F.lit(cuisines).cast("bigint"))


@query("bucketed_join", f"""
WITH {RESTAURANTS}, {TICKETS}
SELECT cuisine_type, COUNT(*) AS orders, {sql_money("amount")} AS revenue
FROM tickets JOIN restaurants USING (restaurant_id) GROUP BY cuisine_type""")
def bucketed_join(spark, sf_dir):
    """Both tables stored by hash of the key: the join shuffles neither. Meant for even keys."""
    places = restaurants(spark, sf_dir).select("restaurant_id", "cuisine_type")
    lines = tickets(spark, sf_dir).select("restaurant_id", "amount")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _database(spark) as database:
        left = create_bucketed_table(lines, database, "tickets", "restaurant_id", buckets)
        right = create_bucketed_table(places, database, "restaurants", "restaurant_id", buckets)
        joined = equi_join(spark.table(left), spark.table(right).hint("merge"), "restaurant_id")
        grouped = joined.groupBy("cuisine_type")
        return stash(grouped.agg(F.count("*").alias("orders"), money_sum(F.col("amount")).alias("revenue")))


# --- physical tuning -------------------------------------------------------------


@query("repartition_cache", f"""
WITH {TICKETS}
SELECT restaurant_id, COUNT(*) AS orders, (SELECT COUNT(*) FROM tickets) AS all_orders FROM tickets GROUP BY 1""")
def repartition_cache(spark, sf_dir):
    """Counts per key, hashed by that key and held for two actions."""
    counts = tickets(spark, sf_dir).groupBy("restaurant_id").agg(F.count("*").alias("orders"))
    with kept(spread_by(counts, "restaurant_id")) as held:
        everything = held.agg(F.sum("orders").alias("n")).first()["n"]
        result = stash(held, "counted")
    return result.withColumn("all_orders", F.lit(everything).cast("bigint"))


@query("few_partitions", f"""
WITH {TICKETS}
SELECT CAST(YEAR(order_date) AS INTEGER) AS year, CAST(MONTH(order_date) AS INTEGER) AS month, COUNT(*) AS orders, true AS few
FROM tickets GROUP BY 1, 2""")
def few_partitions_of_a_report(spark, sf_dir, partitions: int = 2):
    """A small frame that is already computed is merged into few partitions without a shuffle."""
    months = tickets(spark, sf_dir).groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
    computed = stash(months.agg(F.count("*").alias("orders")).repartition(8, "year", "month"), "months")
    merged = fewer_partitions(computed, partitions).withColumn("part", F.spark_partition_id())
    few = merged.agg(F.max("part")).first()[0]
    return merged.withColumn("few", F.lit(few is None or few < partitions)).drop("part")
