"""Text tables in files: collecting inputs, reading, writing and refilling them."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from perplexis.functions.decision import is_missing
from perplexis.functions.naming import DEFAULT_OUTPUT_SUFFIX, is_output_name, output_name
from perplexis.sources.committer import Store, commit, recover, staging_path, work_folder
from perplexis.sources.workspace import spread

# Row identity of a Parquet input: its file and the place in it.
FILE_KEYS = ("file", "row_id")
# Rows whose values are broadcast to where their texts are read: 2 million of some 100 bytes.
WAVE_ROWS = 1 << 21
WAVES_AT_ONCE = 4
LEDGER = "path string, length long, modified timestamp, output string, options string, n_rows long, n_good long, n_null long"


class Input(NamedTuple):
    """A file to read, and where its output goes."""

    path: str
    length: int
    modified: object
    output: str


def list_files(spark: SparkSession, folder_or_file: str) -> DataFrame:
    """``path, length, modified``: the Parquet files directly in a folder, or the file itself."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder_or_file)
    # Without `content` in the plan no file is opened.
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def _file_name() -> Column:
    return F.element_at(F.split("path", "/"), -1)


def inputs_of(spark: SparkSession, given: Sequence[str], include_outputs: bool = False,
              suffix: str = DEFAULT_OUTPUT_SUFFIX, output: str | None = None) -> list[Input]:
    """Files to score: as given, folders as their sorted Parquet files, each with the place of its output.

    An output lies beside its input unless ``output`` names a folder for all;
    there, outputs that would meet under one name carry a hash of the path as well.
    """
    found: list[Input] = []
    for place in given:
        listed = list_files(spark, place)
        if not include_outputs:
            listed = listed.where(~is_output_name(_file_name(), suffix))
        named = listed.withColumn("name", output_name(_file_name(), suffix))
        found += [
            Input(r.path, r.length, r.modified, posixpath.join(output or posixpath.dirname(r.path), r.name))
            for r in named.orderBy("path").toLocalIterator()
        ]
    found = list({f.path: f for f in found}.values())
    places = [f.output for f in found]
    if len(set(places)) < len(places):
        hashes = spark.createDataFrame([(f.path,) for f in found], "path string").select(
            "path", F.hex(F.xxhash64("path")).alias("hash")
        )
        names = {r.path: r.hash.lower() for r in hashes.toLocalIterator()}
        cut = len(suffix) + len(".parquet")
        found = [
            f if places.count(f.output) == 1 else f._replace(output=f"{f.output[:-cut]}-{names[f.path]}{f.output[-cut:]}")
            for f in found
        ]
    return found


def collect_inputs(spark: SparkSession, inputs: Sequence[str], include_outputs: bool = False,
                   suffix: str = DEFAULT_OUTPUT_SUFFIX) -> list[str]:
    """Paths to score: files as given, folders as their sorted Parquet files.

    Files that an earlier run wrote are left out unless gaps are to be filled.
    """
    return [f.path for f in inputs_of(spark, inputs, include_outputs, suffix)]


def file_of_row() -> Column:
    """The path of a row's file as listings spell it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def count_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, n_rows`` out of the file footers, whatever columns the files have."""
    return (
        spark.read.schema("_none int").parquet(*paths)
        .select(F.col("_metadata.file_path").alias("encoded"))
        .groupBy("encoded").agg(F.count("*").alias("n_rows"))
        .select(F.url_decode(F.replace("encoded", F.lit("+"), F.lit("%2B"))).alias("file"), "n_rows")
    )


def _given_name(column: str) -> str:
    return f"given_{column}" if column in FILE_KEYS else column


def read_texts(spark: SparkSession, paths: Sequence[str], limit: int = 0, even: bool = True,
               schema: StructType | None = None) -> DataFrame:
    """All columns of all files plus ``file`` (its path) and ``row_id`` (from 0, in file order).

    Columns of these names in the files are kept as ``given_file`` and
    ``given_row_id``. ``limit`` keeps the first rows of each file, 0 keeps all.
    The schema is merged from all files unless it is given.
    """
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    given = reader.parquet(*paths)
    df = given.select(
        file_of_row().alias("file"), F.col("_metadata.row_index").alias("row_id"),
        *[F.col(f"`{c}`").alias(_given_name(c)) for c in given.columns],
    )
    df = df.where(F.col("row_id") < limit) if limit > 0 else df
    return spread(df) if even else df


def files_without_column(spark: SparkSession, column: str, paths: Sequence[str]) -> list[str]:
    """Those of the files that lack a column."""
    return [p for p in paths if column not in spark.read.parquet(p).columns]


def read_samples(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Paired samples in JSON lines, with an inferred schema unless one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def waves(sizes: Sequence[tuple[str, int]], most: int) -> list[list[str]]:
    """Files in groups of at most ``most`` rows, or of one file."""
    out: list[list[str]] = []
    rows = 0
    for path, n in sizes:
        if not out or rows + n > most:
            out.append([])
            rows = 0
        out[-1].append(path)
        rows += n
    return out


def _whole_files(spark: SparkSession, longest: int) -> SparkSession:
    """A session that splits no file of up to ``longest`` bytes; small ones share a task."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", max(1 << 20, longest))
    session.conf.set("spark.sql.files.minPartitionNum", 1)
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", 64)
    return session


class Staged(NamedTuple):
    """Outputs that wait to be put in place, and what was counted as they were written."""

    staging: str
    moves: list[tuple[str, str]]
    n_rows: int
    n_good: int


def with_values(texts: DataFrame, values: DataFrame, gathered: bool) -> DataFrame:
    """Texts and their ``file, row_id, value`` rows (as ``_value``), in file order.

    Unless the texts are to be gathered in one task, they stay where they are
    read, and the values are broadcast: hand in those of one wave.
    """
    values = values.withColumnRenamed("value", "_value")
    if not gathered:
        return texts.join(F.broadcast(values), list(FILE_KEYS), "left")
    return texts.join(values, list(FILE_KEYS), "left").repartition(1).sortWithinPartitions(*FILE_KEYS)


def stage(spark: SparkSession, folder: str, inputs: Sequence[Input], values: DataFrame,
          merge: Callable[[DataFrame], DataFrame], limit: int = 0, most: int | None = None) -> Staged:
    """Writes each input, as ``merge`` makes it out of its rows and ``_value``, as one part in ``folder``.

    ``values`` are ``file, row_id, value``. Files go in waves of up to ``most``
    rows (``WAVE_ROWS``), whose values are few enough to be broadcast to where the texts are read:
    no text is shuffled. A file of more rows is gathered by its one writer.
    """
    most = most or WAVE_ROWS
    session = _whole_files(spark, max(f.length for f in inputs))
    staging = staging_path(folder)
    outputs = {f.path: f.output for f in inputs}
    sizes = {r.file: r.n_rows for r in count_rows(session, list(outputs)).toLocalIterator()}
    groups = waves([(p, sizes.get(p, 0)) for p in outputs], most)
    numbers = spark.createDataFrame([(p, i) for i, group in enumerate(groups) for p in group], "file string, _wave int")
    values.join(numbers, "file").write.partitionBy("_wave").parquet(f"{staging}/values")
    values = session.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in values.schema)}, _wave int").parquet(f"{staging}/values")
    schema = session.read.option("mergeSchema", True).parquet(*outputs).schema

    def write(number: int) -> tuple[int, int]:
        group = groups[number]
        texts = read_texts(session, group, limit, even=False, schema=schema)
        mine = values.where(F.col("_wave") == number).drop("_wave")
        rows = merge(with_values(texts, mine, sum(sizes.get(p, 0) for p in group) > most))
        kept = [c for c in rows.columns if c not in FILE_KEYS]
        names = [c.removeprefix("given_") if c.removeprefix("given_") in FILE_KEYS else c for c in kept]
        key = "_file"
        while key in names:
            key = f"_{key}"
        counted = Observation()
        out = rows.select(
            F.hex(F.xxhash64("file")).alias(key), *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)]
        ).observe(counted, F.count("*").alias("n_rows"), F.count_if(~is_missing("score")).alias("n_good"))
        out.write.partitionBy(key).parquet(f"{staging}/wave-{number}")
        for path in group:
            if not sizes.get(path):
                # Nothing of it is in the wave; its output has columns only.
                nothing = session.createDataFrame([], out.drop(key).schema).coalesce(1)
                nothing.write.parquet(f"{staging}/wave-{number}/{key}={hashes[path]}")
        return counted.get["n_rows"], counted.get["n_good"]

    hashes = {r.file: r.hash for r in numbers.select("file", F.hex(F.xxhash64("file")).alias("hash")).toLocalIterator()}
    with ThreadPoolExecutor(WAVES_AT_ONCE, "wave") as pool:
        counts = list(pool.map(write, range(len(groups))))

    store, moves = Store(spark), []
    for number, group in enumerate(groups):
        parts = {n.split("=", 1)[1]: f"{staging}/wave-{number}/{n}" for n in store.names(f"{staging}/wave-{number}") if "=" in n}
        for path in group:
            part = parts[hashes[path]]
            (name,) = (n for n in store.names(part) if n.endswith(".parquet"))
            moves.append((f"{part}/{name}", outputs[path]))
    return Staged(staging, moves, sum(n for n, _ in counts), sum(n for _, n in counts))


def put_in_place(spark: SparkSession, folder: str, staged: Staged) -> None:
    """Moves what is staged to its places, behind a journal in ``folder``."""
    commit(Store(spark), folder, staged.staging, staged.moves)


def finish_interrupted(spark: SparkSession, folder: str) -> int:
    """Finishes the moves that an earlier run in ``folder`` left, and clears what it staged."""
    return recover(Store(spark), folder)


def write_named(df: DataFrame, folder: str, name: str) -> None:
    """One Parquet file ``<name>.parquet`` in ``folder`` for each value of a column, which isn't in it."""
    spark, staging = df.sparkSession, staging_path(folder)
    df.repartition(name).write.partitionBy(name).parquet(staging)
    store, moves = Store(spark), []
    for part in store.names(staging):
        if part.startswith(f"{name}="):
            (file,) = (n for n in store.names(f"{staging}/{part}") if n.endswith(".parquet"))
            moves.append((f"{staging}/{part}/{file}", f"{folder}/{part.split('=', 1)[1]}.parquet"))
    commit(store, folder, staging, moves)


def scored_before(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of ``folder``: which files, as they were then, have been scored."""
    ledger = f"{work_folder(folder)}/ledger"
    if not Store(spark).names(ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger)


def enter_in_ledger(rows: DataFrame, folder: str) -> None:
    rows.select([f.split()[0] for f in LEDGER.split(", ")]).coalesce(1).write.mode("append").parquet(
        f"{work_folder(folder)}/ledger"
    )


def write_evaluation(table: DataFrame, folder: str) -> None:
    """CSV with a header: score, class, pred."""
    table.select("score", "class", "pred").write.option("header", True).csv(folder)


def write_record(record: DataFrame, folder: str) -> None:
    """A run's arguments, times and metrics as one JSON row."""
    record.write.option("ignoreNullFields", False).json(folder)
