"""What each filter of a chain removes, in every order of the chain, from one streaming pass.

All files go through as available-now micro-batches. A document becomes a bit mask of the
row-wise filters it fails and a digest of its text. State keyed by text keeps the
rows with the smallest id seen so far; when a smaller one arrives, the mask that the
earlier row was counted under is retracted from the counter of its part, and the row is
counted again as a copy. After the last batch the counters are those of the whole
table, whatever the order of files, and the orders of the chain are sums of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mattercat.session import new_folder

from .common import staged

MOST_FILTERS = 7               # 7! orders of 7 steps: 35,280 rows a part
BUCKET_BYTES = 32 << 20        # input files per bucket of texts; a bucket's state is one value
PARTITION_BYTES = 4 << 30      # input files per partition of the state
SPREAD = 1024                  # groups over which rows that need no state are dealt
STORE = "spark.sql.streaming.stateStore.providerClass"
COUNTER = ["part", "mask", "good", "toxic"]
STATE = ["digest", "doc_id", *COUNTER]


def words_of(text: Column) -> Column:
    """Runs of other characters than ASCII white space; one empty string if there are none."""
    return F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), "[\\x20\\x09-\\x0D]+")


def word_counts(words: str = "words") -> tuple[Column, Column]:
    """Number of words and of different words, from ``words_of``."""
    none = F.element_at(words, 1) == ""
    return F.when(none, 0).otherwise(F.size(words)), F.when(none, 0).otherwise(F.size(F.array_distinct(words)))


def capitals(text: str = "text") -> Column:
    """Number of A-Z in a text."""
    return F.length(F.regexp_replace(F.col(text), "[^A-Z]+", ""))


def summed(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    """Counts by the named columns, those that cancel out left away."""
    if rows.empty:
        return rows[[*by, "n"]]
    rows = rows.groupby(by, sort=False, as_index=False)["n"].sum()
    return rows[rows["n"] != 0]


def bucketed(batch: pa.RecordBatch, copy_bit: int, buckets: int) -> pd.DataFrame:
    """What the state has to see of a batch: its smallest ids by text, and counts of all else.

    A row with a smaller id of the same text beside it is a copy for good, and one without an
    id is never one, so neither needs state; both are only counted. Copies of one
    text, however many, leave one row per part here.
    """
    known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    rows = pd.DataFrame({
        **{c: batch.column(c).to_pylist() for c in ("digest", "part")},
        **{c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "good", "toxic")},
        "doc_id": batch.column("doc_id").fill_null(0).to_numpy(), "n": 1,
    })
    least = rows[known].groupby("digest", sort=False)["doc_id"].transform("min").reindex(rows.index)
    first = known & (rows["doc_id"] == least).to_numpy()
    rest = rows[~first].copy()
    rest["mask"] |= copy_bit * known[~first]
    rest = summed(rest, COUNTER).assign(digest=None, doc_id=0)
    rest["bucket"] = [-1 - hash_part(p) for p in rest["part"]]
    first_rows = summed(rows[first], STATE)
    first_rows["bucket"] = [int.from_bytes(d[:8], "big") % buckets for d in first_rows["digest"]]
    return pd.concat([first_rows, rest], ignore_index=True)


def hash_part(part: str) -> int:
    """A group below ``SPREAD`` for the counts of a part."""
    return int.from_bytes(part.encode()[-4:], "big") % SPREAD


def stepped(kept: pd.DataFrame, rows: pd.DataFrame, copy_bit: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """State after ``rows``, and what to add to the counters: new rows, and retracted ones under their new mask."""
    both = pd.concat([kept.assign(old=True), rows.assign(old=False)], ignore_index=True)
    first = both["doc_id"] == both.groupby("digest", sort=False)["doc_id"].transform("min")
    copies = both[~first].copy()
    copies["mask"] |= copy_bit
    back = both[~first & both["old"]].copy()
    back["n"] = -back["n"]
    changes = pd.concat([both[first & ~both["old"]], copies, back])
    return summed(both[first], STATE), summed(changes, COUNTER)


def packed(rows: pd.DataFrame) -> bytes:
    """State of a bucket as one value."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows[[*STATE, "n"]], schema=STATE_TYPES, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


STATE_TYPES = pa.schema([
    ("digest", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
    ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64()),
])
COUNTS = "part string, mask int, good boolean, toxic boolean, n bigint"


def failure_counts(
    spark: SparkSession, path: str, labels: DataFrame, checks: dict[str, Column], doc_id: str = "doc_id",
    text: str = "text", part: str = "source", batches: int = 4, folder: str | None = None,
) -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents of the Parquet files at ``path`` by what they fail.

    ``checks`` are predicates over the columns ``text`` and ``words`` (see ``words_of``); check ``i`` sets bit ``i`` of the mask,
    and the bit after them says that a smaller id has the same text, anywhere in the table.
    The files go through in about ``batches`` micro-batches. With ``folder`` (in a
    place all executors reach) a run that failed goes on where it stopped, and a later run
    adds only the files that are new; without, a new folder is taken.

    A copy is found by the SHA-256 of its text. The state is held by bucket of
    digests, so that one call handles thousands of texts; a bucket holds
    the texts of about ``BUCKET_BYTES`` of files. It takes some 50 bytes for each different text,
    in the state store of the session: by default in the memory of the executors, with
    ``spark.sql.streaming.stateStore.providerClass`` set to RocksDB's on their disks.
    """
    jvm, base = spark.sparkContext._jvm, folder or new_folder(spark, "audit")
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = files.getContentSummary(where)
    settings = jvm.org.apache.hadoop.fs.Path(f"{base}/settings/_SUCCESS")
    if not settings.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(settings):
        some = max(32, math.ceil(size.getLength() / BUCKET_BYTES))
        spark.range(1).select(F.lit(some).alias("buckets")).write.mode("overwrite").parquet(f"{base}/settings")
    buckets = spark.read.parquet(f"{base}/settings").first()["buckets"]
    marks = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    marks = staged(marks.filter("label_id is not null").withColumn("dealt", F.lit(0).cast("bigint")), "marks")

    # The file source takes folders or patterns; a pattern may name a single file.
    source = f"{path[:-1]}[{path[-1]}]" if files.getFileStatus(where).isFile() else path
    # A session of its own: its settings are those of this stream alone.
    own = spark.newSession()
    if spark.conf.get(STORE, None):
        own.conf.set(STORE, spark.conf.get(STORE))
    own.conf.set("spark.sql.shuffle.partitions", str(max(8, math.ceil(size.getLength() / PARTITION_BYTES))))
    schema = spark.read.parquet(path).select(doc_id, text, part).schema
    stream = (
        own.readStream.schema(schema).option("maxFileAge", "36500d")
        .option("maxFilesPerTrigger", max(1, math.ceil(size.getFileCount() / batches))).parquet(source)
    )
    rows = stream.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("words", words_of(F.col("text")))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(checks.values())), F.lit(0))
    narrow = rows.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    # Rows without an id have no label; they are dealt by their text.
    dealt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("bigint"))
    known = own.read.schema(marks.schema).parquet(*marks.inputFiles()) if marks.inputFiles() else own.createDataFrame([], marks.schema)
    narrow = narrow.withColumn("d", dealt).join(
        known, (F.col("doc_id") == F.col("label_id")) & (F.col("d") == F.col("dealt")), "left"
    ).select("doc_id", "part", "mask", "digest", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    copy_bit = 1 << len(checks)

    def first_of_batch(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks:
            if batch.num_rows:
                yield pa.RecordBatch.from_pandas(bucketed(batch, copy_bit, buckets), schema=SENT, preserve_index=False)

    def keep_minima(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            for frame in frames:
                yield summed(frame, COUNTER)[[*COUNTER, "n"]]
            return
        kept = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else None
        for frame in frames:
            frame = summed(frame, STATE)
            kept, changes = stepped(frame.iloc[:0] if kept is None else kept, frame, copy_bit)
            yield changes[[*COUNTER, "n"]]
        state.update((packed(kept),))

    SENT = pa.schema([("bucket", pa.int64()), *STATE_TYPES])
    sent = "bucket bigint, digest binary, doc_id bigint, part string, mask int, good boolean, toxic boolean, n bigint"
    changes = narrow.mapInArrow(first_of_batch, sent).groupBy("bucket").applyInPandasWithState(
        keep_minima, COUNTS, "rows binary", "append", GroupStateTimeout.NoTimeout
    )
    # The file sink commits each batch once.
    changes.writeStream.format("parquet").outputMode("append").option("path", f"{base}/changes").option(
        "checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    changed = spark.read.schema(COUNTS).parquet(f"{base}/changes")
    return changed.groupBy(*COUNTER).agg(F.sum("n").alias("n")).filter("n <> 0")


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """Every step of every order of the filters, by part, from counts by failure mask.

    Letter ``i`` is bit ``i`` of ``mask``. What a step removes depends on the filter and the
    set of those before it, not on their order, so sums are made for each filter and
    set and then handed to all steps that share them. ``shapley`` is exact: a document that
    fails ``m`` filters is removed by each of them in a ``m``-th of all orders.
    """
    k = len(letters)
    if not 1 <= k <= MOST_FILTERS or len(set(letters)) < k:
        raise ValueError(f"1 to {MOST_FILTERS} different letters are needed")
    spark = counts.sparkSession
    per_mask = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    cases = F.array(*[
        F.struct(F.lit(1 << x).alias("bit"), F.lit(before).alias("before"))
        for x in range(k) for before in range(1 << k) if not before >> x & 1
    ])
    rows = per_mask.select("*", F.inline(cases))
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0

    def total(value: str | Column, where: Column, name: str) -> Column:
        return F.sum(F.when(where, value if isinstance(value, Column) else F.col(value)).otherwise(0)).cast("bigint").alias(name)

    share = (F.col("n") * math.factorial(k) / F.bit_count("mask")).cast("bigint")
    sums = rows.groupBy("part", "bit", "before").agg(
        total("n", ~fails & ~earlier, "kept"), total("n", fails & ~earlier, "removed"),
        total("n", fails & earlier, "redundant"), total("n", F.col("mask") == F.col("bit"), "unique_fails"),
        total("good", fails & ~earlier, "good_lost"), total("toxic", fails & ~earlier, "toxic_lost"),
        total(share, fails, "shapley"),
    )
    steps = []
    for order in permutations(range(k)):
        before = 0
        for at, x in enumerate(order):
            steps.append(("".join(letters[i] for i in order), at + 1, 1 << x, before))
            before |= 1 << x
    plan = spark.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    return sums.join(F.broadcast(plan), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(
    spark: SparkSession, path: str, labels: DataFrame, checks: dict[str, Column], copies: str, **options
) -> DataFrame:
    """One row per part, order of filters and step: what is kept, removed and lost there.

    ``checks`` names row-wise failure conditions over ``text`` and ``words``, ``copies`` is the letter of the
    filter that removes texts equal to one with a smaller doc_id; ``options`` are those of ``failure_counts``.
    ``labels`` holds ``(doc_id, quality, toxic)``.

    A null text is empty and a null part the empty string. A row without a doc_id has
    no label, is no copy and makes none. Repeated rows are counted each, and
    rows that share the smallest id of a text are all no copies; with repeated labels, one that
    holds is enough. Texts of any length are read whole. Other columns are not
    read, whatever their names. No files or no rows give no rows. doc_ids are integers.
    """
    return interactions(failure_counts(spark, path, labels, checks, **options), "".join(checks) + copies)
