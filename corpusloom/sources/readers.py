"""Readers for bitext archives, score parts and statistics."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fixed value: language pairs as directories.
PAIR_NAME = r"^[a-z]{3}_[A-Z][a-z]{3}-[a-z]{3}_[A-Z][a-z]{3}$"
#: Fixed value: the text columns of older corpora.
OLD_TEXT_NAMES = {"src_text": "source_text", "tgt_text": "target_text"}


def valid_pair(name: Column) -> Column:
    return F.coalesce(name.rlike(PAIR_NAME), F.lit(False))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns missing: {missing}")
    return df


def read_zip_bitext(spark: SparkSession, path: str, source: str, target: str) -> DataFrame:
    """``path, line_no, source_text, target_text`` of zip archives with a line-aligned file ``*.<source>`` and ``*.<target>``.

    Lines are stripped; the shorter file ends a pair. An archive without both files, or that can't be read, has no row.
    An archive is unpacked as a stream within one task.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                names = archive.namelist()
                a, b = (next((n for n in names if n.endswith(f".{x}")), None) for x in (source, target))
                if a is None or b is None:
                    continue
                with archive.open(a) as x, archive.open(b) as y:
                    lines = zip(io.TextIOWrapper(x, "utf-8", errors="replace", newline="\n"), io.TextIOWrapper(y, "utf-8", errors="replace", newline="\n"))
                    rows: list[tuple] = []
                    for n, (s, t) in enumerate(lines):
                        rows.append((path, n, s.strip(), t.strip()))
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    columns = ["path", "line_no", "source_text", "target_text"]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(unpack, "path string, line_no bigint, source_text string, target_text string")


def map_code(code: Column, three_part: Column, iso3: Column) -> Column:
    """A language code as ``lang_script``: the mapped three-part code cut to two parts, else the ISO 639-3 code, else itself."""
    parts = F.split(three_part, "_")
    return F.coalesce(F.when(F.size(parts) >= 2, F.concat_ws("_", parts[0], parts[1])), iso3, code)


def map_languages(rows: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``conv_<column>`` for each: the mapped code, both sides checked alike. ``mapping``: code, three_part, iso3."""
    for c in columns:
        m = mapping.select(F.col("code").alias("_k"), F.col("three_part").alias("_t"), F.col("iso3").alias("_i")).dropDuplicates(["_k"])
        rows = rows.join(m, F.col(c) == F.col("_k"), "left").withColumn(f"conv_{c}", map_code(F.col(c), F.col("_t"), F.col("_i"))).drop("_k", "_t", "_i")
    return rows


def normalised_code(code: Column, script: Column, fixes: dict[str, str] | None = None) -> Column:
    """A language code as ``xxx_Ssss``: a fixed one by the map, one that has the form as it is, a bare three-letter code
    with the script of its texts, anything else ``und_Zyyy``."""
    fixed = F.create_map(*[F.lit(x) for kv in fixes.items() for x in kv])[code] if fixes else F.lit(None).cast("string")
    bare = F.when(code.rlike("^[a-z]{3}$"), F.concat(code, F.lit("_"), F.coalesce(script, F.lit("Zyyy"))))
    return F.coalesce(fixed, F.when(code.rlike("^[a-z]{3}_[A-Z][a-z]{3}$"), code), bare, F.lit("und_Zyyy"))


def majority_script(rows: DataFrame, keys: list[str], text: str, order: list[str], texts: int | None = None) -> DataFrame:
    """``keys, script, share``: the script most letters of a group's texts are in; ``Zyyy`` without any letter.

    Letters are summed on the map side. ``texts``: only so many of each group, the first in ``order``."""
    from corpusloom.functions.text import letter_count

    names = {"Latn": "Latin", "Cyrl": "Cyrillic", "Grek": "Greek", "Arab": "Arabic", "Hani": "Han", "Thai": "Thai", "Deva": "Devanagari", "Hebr": "Hebrew", "Hang": "Hangul"}
    if texts is not None:
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= texts)
    t = F.coalesce(F.col(text), F.lit(""))
    counts = [F.sum(F.length(t) - F.length(F.regexp_replace(t, rf"\p{{Is{n}}}", ""))).alias(c) for c, n in names.items()]
    sums = rows.groupBy(*keys).agg(F.sum(letter_count(t)).alias("_letters"), *counts)
    # On a tie the first in alphabetical order counts.
    top = F.array_max(F.array(*[F.struct(F.col(c).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(sorted(names))]))
    return sums.select(*keys, F.when(top["n"] > 0, top["c"]).otherwise("Zyyy").alias("script"), F.when(F.col("_letters") > 0, top["n"] / F.col("_letters")).alias("share"))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned Parquet of parts that differ in columns, with hive columns and each row's file."""
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "false").parquet(path)
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def path_fields(path: Column) -> dict[str, Column]:
    """Model, direction and languages of a part's path: ``<model>/<direction>/<direction>[.part-N].parquet`` or
    ``<model>/<direction>.parquet``; backslashes are slashes."""
    clean = F.replace(path, F.lit("\\"), F.lit("/"))
    parent, above = F.regexp_extract(clean, r"/([^/]+)/[^/]+$", 1), F.regexp_extract(clean, r"/([^/]+)/[^/]+/[^/]+$", 1)
    name = F.regexp_replace(F.regexp_extract(clean, r"/([^/]+)[.]parquet$", 1), r"[.]part-[0-9]+$", "")
    own = parent == name
    direction = F.when(own, parent).otherwise(name)
    return {
        "model": F.when(own, above).otherwise(parent), "direction_key": direction,
        "src_lang": F.split_part(direction, F.lit("-"), F.lit(1)), "tgt_lang": F.split_part(direction, F.lit("-"), F.lit(2)),
    }


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, bad: str = "count") -> DataFrame:
    """JSON lines. ``bad`` lines: ``count`` keeps them in ``_corrupt_record``, ``skip`` drops them, ``fail`` raises."""
    if bad == "count":
        text = schema if isinstance(schema, str) else schema.toDDL()
        return spark.read.schema(f"{text}, _corrupt_record string").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return spark.read.schema(schema).option("mode", {"skip": "DROPMALFORMED", "fail": "FAILFAST"}[bad]).json(path)


def read_catalogue(spark: SparkSession, path: str, schema: str, field: str = "corpora") -> DataFrame:
    """The entries of a catalogue service's JSON answers that were saved to files, one row each. Fetching them is left to
    the caller: jobs have no network."""
    answers = spark.read.schema(f"{field} array<struct<{', '.join(part.strip().replace(' ', ': ', 1) for part in schema.split(','))}>>").option("multiLine", "true").json(path)
    return answers.select(F.explode(field).alias("_e")).select("_e.*")


def _workbook_rows(content: bytes) -> Iterator[list[str | None]]:
    """The rows of a workbook's first sheet as text."""
    name = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = []
        if "xl/sharedStrings.xml" in archive.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{name}t")) for item in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")).iter(f"{name}si")]
        with archive.open("xl/worksheets/sheet1.xml") as sheet:
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{name}row":
                    continue
                cells: dict[int, str] = {}
                for k, c in enumerate(row.iter(f"{name}c")):
                    place = reduce(lambda n, x: 26 * n + ord(x) - 64, (x for x in c.get("r", "") if x.isalpha()), 0) - 1
                    value = c.find(f"{name}v")
                    text = "".join(t.text or "" for t in c.iter(f"{name}t")) if c.get("t") == "inlineStr" else None if value is None else value.text
                    cells[place if place >= 0 else k] = shared[int(text)] if c.get("t") == "s" and text is not None else text
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                row.clear()


def read_workbook(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``columns`` of the first sheets of workbooks as text, by the names in their first rows; rows without any value
    are left out, and a file that is no workbook, or lacks a column, has no row. One task reads a workbook."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                try:
                    rows = _workbook_rows(content)
                    head = next(rows, [])
                    at = [head.index(c) for c in columns]
                    found = [[r[i] if i < len(r) else None for i in at] for r in rows]
                except (zipfile.BadZipFile, KeyError, ValueError, ElementTree.ParseError):
                    continue
                yield pd.DataFrame([r for r in found if any(v is not None for v in r)], columns=columns, dtype=object)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(parse, ", ".join(f"`{c}` string" for c in columns))


def read_stats(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """CSV statistics and their chunk siblings as one table; of rows with equal keys that of the last file, last line, counts."""
    raw = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    values = [c for c in raw.columns if c not in keys]
    placed = raw.select("*", F.col("_metadata.file_path").alias("_f"), F.monotonically_increasing_id().alias("_n"))
    last = placed.groupBy(*keys).agg(F.max(F.struct("_f", "_n", *values)).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{v}").alias(v) for v in values])
