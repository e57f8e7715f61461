"""What the corpus operators share: column names, written intermediates, components."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.session import delete_path, scratch


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


class Saved:
    """A DataFrame written below ``spark.checkpoint.dir`` and read back.

    Every executor can read it again after one is lost, and it cuts the lineage.
    """

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` from files that stay as long as the result that is built on them may be read."""
    return Saved(df, name).df


#: Bits of a bitmap per key, which let one other row in sixteen through, and at most (32 MB).
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
_CHUNK = 15  # bits of a position within a bitmap of bitmap_construct_agg


def may_be_in(rows: DataFrame, key: Column, wanted: DataFrame, name: str, most_bits: int = MOST_BITS) -> DataFrame:
    """``rows`` with ``name``: false where the hash ``key`` is surely not the one column of ``wanted``.

    A bitmap of the wanted hashes is broadcast, so wide rows that a join would drop need no shuffle
    to be told apart. Some rows that are not wanted are true as well, more of them where the bitmap has reached
    ``most_bits``: a join has to follow.
    """
    wanted = wanted.toDF("key")
    bits = 1 << max(_CHUNK, (min(BITS_PER_KEY * wanted.count(), most_bits) - 1).bit_length())
    place = lambda hashed: F.pmod(hashed, F.lit(bits))
    chunk, bitmap = unused(rows, f"{name}_chunk"), unused(rows, f"{name}_bitmap")
    at = place(F.col("key"))
    held = wanted.groupBy(F.shiftright(at, _CHUNK).alias(chunk)).agg(
        F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << _CHUNK) - 1))).alias(bitmap))
    spot = unused(rows, f"{name}_spot")
    bit = F.col(spot).bitwiseAND(F.lit((1 << _CHUNK) - 1))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn(spot, place(key)).join(F.broadcast(held), F.shiftright(F.col(spot), _CHUNK) == F.col(chunk), "left")
    return found.withColumn(name, F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))).drop(spot, chunk, bitmap)


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a document by id and text, so that rows which repeat an id stay apart."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.xxhash64(F.coalesce(text, F.lit(""))))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``links(a, b)``: ``(node, root)``, the root being the least node.

    Alternates between linking each node's neighbours to the least of them and following roots,
    which halves paths, until a round changes nothing. Every round is written and read back.
    Nodes without a link do not appear. No round gathers the neighbours of a node: minima are
    combined before the shuffle, so a node with many links costs one row per task.
    """
    now = Saved(links.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        # Each node's least neighbour on either side, itself included.
        both = now.df.select("a", "b").union(now.df.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # A link (a, b) becomes (a, m(b)) and (b, m(a)), and a node points at its own least.
        # Written first: a join of two plain reads is one whose hot nodes Spark can split.
        least = Saved(least, name)
        via = both.join(least.df.withColumnRenamed("a", "b"), "b")
        nxt = Saved(
            via.select("a", F.col("m").alias("b"))
            .union(least.df.select("a", F.col("m").alias("b")))
            .where("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        # Done when every node has one link, to a node that has no lesser one.
        ends = nxt.df.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            nxt.df.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        unfinished = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
            "up > 1 or up = 1 and down = 1").limit(1).count()
        now.drop()
        least.drop()
        now = nxt
        if not unfinished:
            break
    out = now.df
    return out.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        out.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
