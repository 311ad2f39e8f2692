"""Table readers and the rating / item tables derived from the test tables.

The reference reads catalog tables (ratings splits, movies, links) and a
remote movie-detail service. Here every one of those is a DataFrame derived
from the driver's parquet tables (see FIXTURES.md for the definition):

* ratings: one row per (customer, part) -- the newest line item wins --
  rating = ceil(quantity / 5) / 2, split 80/10/10 per user in time order.
* movies:  one row per part; genres "type|second word of the name".
* links:   part -> external id, with some parts left out.
* details: external id -> localised title, poster path, release date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrank.operators.ordinal import with_ordinal
from reelrank.session import ensure_checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

HOT_LINES = 1_000_000   # line items of a user that one task still sorts
LINES_A_TASK = 250_000  # line items that a task dedupes and numbers (about 175 MB in its three sorts)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one named parquet table of a scale-factor directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId:int, movieId:int, rating:double, ts:timestamp, split:string.

    Rows are dealt once by user, over as many tasks as there are
    ``LINES_A_TASK`` of line items; a task drops what is not the newest of its
    (user, item) pairs and numbers each user's rows in time order. Users of
    more than ``HOT_LINES`` line items are kept out of that: their dedupe is
    keyed by (user, item) and their positions come from the range-partitioned
    ordinal, so that no task holds the whole of one.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").filter(F.col("o_custkey").isNotNull())
    of_order = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    ensure_checkpoint_dir(spark)
    hot = (of_order.join(od, of_order.l_orderkey == od.o_orderkey)
           .groupBy("o_custkey").agg(F.sum("lines").alias("lines"))
           .filter(F.col("lines") > HOT_LINES).select("o_custkey")).checkpoint()
    if hot.isEmpty():
        return _with_split(_window_positions(_lines_by_user(li, od)))
    usual = _window_positions(_lines_by_user(li, od.join(hot, "o_custkey", "left_anti")))
    newest = _newest(_joined(li, od.join(hot, "o_custkey", "left_semi")))
    return _with_split(usual.unionByName(with_ordinal(newest, "o_custkey", ["ts", "l_partkey"]).select(*usual.columns)))


def _joined(li: DataFrame, od: DataFrame) -> DataFrame:
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select("o_custkey", "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"))


def line_tasks(lines: int, cores: int) -> int:
    """Tasks for that many line items: their number decides, as shuffled bytes
    say little of what three sorts of them hold."""
    return max(-(-lines // LINES_A_TASK), min(cores, 10 * lines // LINES_A_TASK))


def _lines_by_user(li: DataFrame, od: DataFrame) -> DataFrame:
    lines = li.count()                                            # one scalar
    if lines <= LINES_A_TASK:
        return _joined(li, od).repartition("o_custkey")
    return _joined(li, od).repartition(line_tasks(lines, li.sparkSession.sparkContext.defaultParallelism), "o_custkey")


def _newest(lines: DataFrame) -> DataFrame:
    """The newest line of each (user, item): a maximum over a struct ordered
    like the tie-break."""
    w = F.max(F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")).alias("w")
    return (lines.groupBy("o_custkey", "l_partkey").agg(w)
            .select("o_custkey", "l_partkey", F.col("w.l_shipdate").alias("ts"), F.col("w.l_quantity").alias("l_quantity")))


def _window_positions(lines: DataFrame) -> DataFrame:
    # grouping and windows keep to the partitioning by user: no further shuffle
    of_user = Window.partitionBy("o_custkey")
    return _newest(lines).select("o_custkey", "l_partkey", "ts", "l_quantity",
                                 F.row_number().over(of_user.orderBy("ts", "l_partkey")).alias("pos"),
                                 F.count(F.lit(1)).over(of_user).cast("int").alias("n"))


def _with_split(ordered: DataFrame) -> DataFrame:
    split = (F.when(F.col("pos") * 10 <= F.col("n") * 8, "train")
              .when(F.col("pos") * 10 <= F.col("n") * 9, "validation")
              .otherwise("test"))
    return ordered.select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("rating"),
        "ts", split.alias("split"))


def state(spark: SparkSession, sf_dir: str) -> tuple:
    """Newest modification time and total size of the files of the tables that
    ratings and items are derived from; their content is not read."""
    paths = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("lineitem", "orders", "part")]
    files = spark.read.format("binaryFile").load(paths).select("modificationTime", "length")
    return tuple(files.agg(F.max("modificationTime").cast("string"), F.sum("length")).first())


def split(r: DataFrame, name: str) -> DataFrame:
    return r.filter(F.col("split") == name).drop("split")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId:int, title, genres ('A|B'), year (string, cast later as in the reference)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("title"),
        F.concat("p_type", F.lit("|"), F.split_part("p_name", F.lit(" "), F.lit(2))).alias("genres"),
        (F.lit(1970) + F.col("p_size")).cast("string").alias("year"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """movieId:int -> tmdbId:bigint; parts of size 13 have no link."""
    p = read_table(spark, sf_dir, "part")
    return (p.filter(F.col("p_size") != 13)
             .select(F.col("p_partkey").cast("int").alias("movieId"),
                     (F.col("p_partkey") * 7 + 3).cast("bigint").alias("tmdbId")))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tmdb_id -> title_ko, poster_path (NULL for Brand#1), release_date."""
    p = read_table(spark, sf_dir, "part")
    return (p.filter(~F.col("p_size").isin(13, 14))
             .select((F.col("p_partkey") * 7 + 3).cast("bigint").alias("tmdb_id"),
                     F.concat(F.lit("ko-"), "p_name").alias("title_ko"),
                     F.when(F.col("p_brand") == "Brand#1", F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("/"), F.col("p_partkey").cast("string"),
                                          F.lit(".jpg"))).alias("poster_path"),
                     F.concat((F.lit(1970) + F.col("p_size")).cast("string"),
                              F.lit("-01-01")).alias("release_date")))


def denormalised(r: DataFrame, m: DataFrame) -> DataFrame:
    """Ratings with title, genres and year attached (the ``*_temp`` tables).

    The item table is joined by key; Spark picks broadcast vs shuffle from the
    measured size (AQE), since the catalogue grows with the data.
    """
    return r.join(m, "movieId", "left")
