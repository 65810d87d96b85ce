"""Writers: shards by rows or bytes, partitioned tables, published folders, training lines, scorer inputs."""

from __future__ import annotations

import json
import math
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.keys import join_groups
from corpusloom.operators.prefix import row_numbers, running_sum


def write_shards(rows: DataFrame, path: str, most_rows: int, by: list[str] = (), mode: str = "overwrite") -> None:
    """Parquet files of at most ``most_rows`` rows, in directories by ``by``; no file is empty."""
    writer = rows.write.mode(mode).option("maxRecordsPerFile", most_rows)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_sized(rows: DataFrame, path: str, most_bytes: int, bytes_per_row: float, mode: str = "overwrite") -> None:
    """Parquet files of about ``most_bytes``, by an estimate of a row's size."""
    write_shards(rows, path, max(1, int(most_bytes / bytes_per_row)), mode=mode)


def byte_shards(rows: DataFrame, group: list[str], order: list[Column], size: Column, most_bytes: int) -> DataFrame:
    """``rows`` with ``file_no`` from 0 in their group: a file takes rows in ``order`` until it holds ``most_bytes`` of
    ``size``, and the row that reaches that is its last but never in two. Sizes are summed over slices."""
    summed = running_sum(rows.withColumn("_size", F.coalesce(size, F.lit(0)).cast("bigint")), group, order, F.col("_size"), "_to")
    return summed.withColumn("file_no", F.floor((F.col("_to") - F.col("_size")) / most_bytes).cast("bigint")).drop("_size", "_to")


def write_rotated(rows: DataFrame, path: str, group: list[str], order: list[Column], size: Column, most_bytes: int) -> None:
    """Parquet in folders ``group/file_no``, each of rows of about ``most_bytes``."""
    byte_shards(rows, group, order, size, most_bytes).write.mode("overwrite").partitionBy(*group, "file_no").parquet(path)


def rehome_plan(files: DataFrame, home: str, new_home: str, name: str) -> DataFrame:
    """``files`` (one row a file) with ``new_name``: a file whose home changes moves there, and one that finds its name
    taken by a file that stays or by an earlier move, in the order of the old homes, gets ``.moved-N``."""
    place = Window.partitionBy(new_home, name).orderBy((F.col(home) != F.col(new_home)).cast("int"), home)
    n = F.row_number().over(place) - 1  # one row a home that moves into another
    return files.withColumn("new_name", F.when(n == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit(".moved-"), n)))


def rehome(rows: DataFrame, path: str, home: str, new_home: str, name: str) -> None:
    """Rewrite ``rows`` by their new homes in folders ``new_home/new_name``; homes that nothing is left in vanish."""
    plan = rehome_plan(rows.select(home, new_home, name).distinct(), home, new_home, name)
    moved = join_groups(rows, plan, [home, new_home, name])
    moved.drop(home, name).write.mode("overwrite").partitionBy(new_home, "new_name").parquet(path)


def verify_union(parts: list[DataFrame], merged: DataFrame, rename: dict[str, str] | None = None) -> int:
    """The number of rows of ``merged``, which must be that of all ``parts`` together and have all their columns with
    their types, renamed; else an error says what differs."""
    kinds = {(rename or {}).get(f.name, f.name): f.dataType for part in parts for f in part.schema}
    if wrong := sorted(n for n, kind in kinds.items() if n not in merged.columns or merged.schema[n].dataType != kind):
        raise ValueError(f"columns differ after the merge: {wrong}")
    before, after = sum(p.count() for p in parts), merged.count()
    if before != after:
        raise ValueError(f"{before} rows were merged, {after} are there")
    return after


def remove_merged_inputs(spark: SparkSession, inputs: str, merged: str, dry_run: bool = True) -> list[str]:
    """Names of the folders in ``inputs`` of which ``merged`` has a finished output (with ``_SUCCESS``); unless
    ``dry_run`` they are deleted."""
    fs, root = _fs(spark, inputs)
    _, out = _fs(spark, merged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    done = [n for n in names if out.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path(f"{merged}/{n}/_SUCCESS"))]
    for n in [] if dry_run else done:
        fs.delete(path(f"{inputs}/{n}"), True)
    return done


def shard_numbers(rows: DataFrame, group: list[str], order: list[Column], size: int) -> DataFrame:
    """``rows`` with ``row_index`` (from 0) and ``shard_id`` in a total order; exact without a global window."""
    numbered = row_numbers(rows, group, order, "_n")
    return numbered.withColumn("row_index", F.col("_n") - 1).withColumn("shard_id", F.floor((F.col("_n") - 1) / size).cast("bigint")).drop("_n")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def publish(rows: DataFrame, path: str, expected: int | None = None, **notes) -> dict:
    """Write to a staging folder, check the row count, and put the folder in the place of ``path``, with ``_MANIFEST.json``.

    The old folder is moved aside, the new one renamed, and only then the old one deleted: a reader never finds a part of
    either, and a crash loses neither. Between the two renames there is no folder; if a crash comes just then, the next
    call first puts the old one back. The manifest has the row count, the schema, the notes, and a digest of all of them."""
    spark, root = rows.sparkSession, path.rstrip("/")
    staging, aside = f"{root}.staging", f"{root}.old"
    fs, target = _fs(spark, root)
    stage, old = (_fs(spark, p)[1] for p in (staging, aside))
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        else:
            _rename(fs, old, target)
    rows.write.mode("overwrite").parquet(staging)
    n = spark.read.parquet(staging).count()
    if expected is not None and n != expected:
        raise ValueError(f"{n} rows were written, {expected} expected")
    manifest = {"rows": n, "schema": rows.schema.simpleString(), **notes}
    manifest["digest"] = digest(manifest)
    out = fs.create(_fs(spark, f"{staging}/_MANIFEST.json")[1])
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    if fs.exists(target):
        _rename(fs, target, old)
    _rename(fs, stage, target)
    fs.delete(old, True)
    return manifest


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} can't be renamed to {target}")


def digest(inputs: dict) -> str:
    """SHA-256 of settings and inputs, whatever the order of keys."""
    return sha256(json.dumps(inputs, sort_keys=True, default=str).encode()).hexdigest()


def same_run(*manifests: dict) -> None:
    """Refuse to combine results of different runs."""
    if len({m["digest"] for m in manifests}) > 1:
        raise ValueError("the manifests are of different runs")


def check_conserved(rows_in: int, eligible: int, rejected: int, written: int, kept: int) -> None:
    if rows_in != eligible + rejected or written != kept:
        raise ValueError(f"rows were lost: {rows_in} in, {eligible} eligible and {rejected} rejected; {kept} kept, {written} written")


def flat(text: Column) -> Column:
    """A text on one line without tabs, null as empty."""
    return F.coalesce(F.translate(text, "\t\r\n", "   "), F.lit(""))


def write_scorer_tsv(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*[flat(F.col(c).cast("string")).alias(c) for c in columns]).write.mode("overwrite").option("sep", "\t").option("quote", "\u0000").option("emptyValue", "").csv(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """The last tab-separated column of each line as a score; null where it is no number."""
    lines = spark.read.text(path)
    return lines.select(F.substring_index("value", "\t", -1).try_cast("double").alias("score"))


def jsonl_to_parquet(spark: SparkSession, source: str, target: str, schema: str) -> None:
    spark.read.schema(schema).json(source).write.mode("overwrite").parquet(target)


def training_lines(rows: DataFrame, group: list[str], order: list[Column], source_lang: str, target_lang: str, source: str, target: str,
                   names: dict[str, str], per_line: int = 1, english: str = "eng_Latn") -> DataFrame:
    """``group, line_no, text``: ``{Lang}: text`` on two lines per pair, ``per_line`` pairs a line of output.

    Of pairs with English the first half of a group (rounded up) reads from English, the other half into it. Both texts
    must be there; a language without a name appears with its code.
    """
    whole = rows.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
    sizes = whole.groupBy(*group).agg(F.count("*").alias("_all"))
    numbered = row_numbers(whole, group, order, "_n").join(sizes, group)
    half = F.ceil(F.col("_all") / 2)
    with_english = (F.col(source_lang) == english) | (F.col(target_lang) == english)
    second_half = with_english & (F.col("_n") > half)
    english_first = with_english & ~second_half
    source_first = F.when(with_english, (F.col(source_lang) == english) == english_first).otherwise(True)
    at = F.when(second_half, F.col("_n") - half).otherwise(F.col("_n")) - 1  # place in its half
    line = F.when(second_half, F.ceil(half / per_line)).otherwise(F.lit(0)) + F.floor(at / per_line)
    name = lambda c: F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[c], c)
    one = lambda lang, text: F.concat(name(F.col(lang)), F.lit(": "), F.col(text))
    s, t = one(source_lang, source), one(target_lang, target)
    pair = F.when(source_first, F.concat_ws("\n", s, t)).otherwise(F.concat_ws("\n", t, s))
    placed = numbered.select(*group, line.cast("bigint").alias("line_no"), F.struct("_n", pair.alias("p")).alias("x"))
    joined = placed.groupBy(*group, "line_no").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # per_line rows
    return joined.select(*group, "line_no", F.array_join(F.transform("xs", lambda x: x["p"]), "\n\n").alias("text"))


def rows_per_file(total_rows: int, files: int) -> int:
    return max(1, math.ceil(total_rows / files))
