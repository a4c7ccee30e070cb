"""File sources: event archives, listing / catalog / sales / billing files, reports."""

from __future__ import annotations

import bz2
import io
import itertools
import re
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions import scalars as S
from forecourt.functions.payload import pack_payload
from forecourt.functions.vehicle import clean_source_domain
from forecourt.operators import filters
from forecourt.operators.joins import SALTS, left_lookup
from forecourt.operators.spread import spread_join
from forecourt.session import is_folder, materialize

# The typed listing columns and the file columns they come from.
LISTING_COLUMNS = (
    ("id", "id"),
    ("dealer_id", "dealer_id_is"),
    ("vin", "vin_ss"),
    ("price", "price_fs"),
    ("miles", "miles_fs"),
    ("taxonomy_vin", "taxonomy_vin_ss"),
    ("scraped_at", "scraped_at_dts"),
    ("status_date", "status_date_dts"),
    ("zip", "zip_is"),
    ("latitude", "latitude_fs"),
    ("longitude", "longitude_fs"),
    ("city", "city_ss"),
    ("state", "state_ss"),
    ("domain", "source_ss"),
    ("miles_indicator", "miles_indicator_ss"),
    ("currency_indicator", "currency_indicator_ss"),
)
# Columns kept for the free-text features of a listing.
FEATURE_COLUMNS = (
    "vin_ss", "taxonomy_vin_ss", "scraped_at_dts", "status_date_dts", "more_info_ss", "options_texts", "features_texts",
)
# Columns kept by the dealer-contact import.
CONTACT_COLUMNS = (
    "dealer_id_is", "source_ss", "zip_is", "address_ss", "city_ss", "state_ss", "street_ss", "seller_email_ss",
    "seller_phone_ss", "seller_name_orig_ss",
)

LISTING_PROFILES = {
    "ca_new": filters.listing_ca_new,
    "ca_used": filters.listing_ca_used,
    "us_used": filters.listing_us_used,
}

BLOCK_LINES = 4096


# The column that takes the text of a row with too few or too many fields.
BROKEN = "_broken"
FILE_COLUMNS = {"file": "file_path", "last_modified": "file_modification_time", "block": "file_block_start"}


#: Bytes of a file that are asked for at a time until its first line has ended.
HEAD_BYTES = 4096


def first_line(stream, codec: str = "") -> bytes | None:
    """The first line of an open file, which is read no further; None if it has no bytes."""
    unpack = {"gz": lambda: zlib.decompressobj(31), "deflate": zlib.decompressobj, "bz2": bz2.BZ2Decompressor}
    inner = unpack[codec]() if codec else None
    held = b""
    while not (end := re.search(rb"[\r\n]", held)):
        piece = stream.read(HEAD_BYTES)
        if not piece:
            return held or None
        held += inner.decompress(piece) if inner else piece
    return held[: end.start()]


def stored_at(file: str) -> tuple[pa_fs.FileSystem, str]:
    """The store and place of a file that Spark names; Spark escapes only some characters."""
    return pa_fs.FileSystem.from_uri(quote(file, safe="%/:@!$&'()*+,;=~-._"))


def header_lines(spark: SparkSession, path: str | Sequence[str], modified_after: str | None = None) -> DataFrame:
    """(file, header): the first line of every file that is not empty.

    The files are listed as for any read and not scanned: tasks open them and
    stop after the first line. A store or codec that only Spark can open leaves
    ``header`` NULL.
    """
    reader = spark.read.format("binaryFile")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    listed = reader.load(path).where("length > 0").select(F.col("_metadata.file_path").alias("file"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, lines = [], []
            for file in batch.column(0).to_pylist():
                suffix = re.search(r"\.(gz|deflate|bz2|zstd?|snappy|lz4|lzo)$", file)
                codec = suffix[1] if suffix else ""
                try:
                    system, at = stored_at(file)
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
                    system = None
                if system is None or codec not in ("", "gz", "deflate", "bz2"):
                    files.append(file)
                    lines.append(None)
                    continue
                with system.open_input_stream(at, compression=None) as stream:
                    line = first_line(stream, codec)
                if line is not None:
                    files.append(file)
                    lines.append(line.decode("utf-8", "replace").removeprefix("\ufeff"))
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(lines, pa.string())], names=["file", "header"])

    return listed.mapInArrow(run, "file string, header string")


def scanned_header_lines(spark: SparkSession, path: str | Sequence[str], modified_after: str | None = None) -> DataFrame:
    """As `header_lines`, by Spark's own reader, which reads the files whole."""
    reader = spark.read.option("modifiedAfter", modified_after) if modified_after else spark.read
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("at"),
        F.regexp_replace("value", "^\ufeff", "").alias("value"),
    )
    return lines.where(F.col("at.block") == 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    modified_after: str | None = None,
    quote: str = '"',
    strict: bool = False,
    broken: bool = False,
    file: bool = False,
) -> DataFrame:
    """Delimited file(s), every column text, one physical line per record; columns go by each file's own header.

    Files of one header are read together. Columns stand in the order in which
    the headers, sorted, name them; a file that lacks a column has NULL there.
    A row with too few or too many fields is padded or cut; with ``broken`` its
    text is kept in the column ``_broken`` (`count_broken` counts them), with
    ``strict`` it is an error. ``file`` adds the columns of FILE_COLUMNS. The
    driver gets the different headers with a file of each; only where there are
    several does it list their files, as any read of them does.
    """
    heads = header_lines(spark, path, modified_after)
    files = {r["header"]: [unquote(r["file"])] for r in heads.groupBy("header").agg(F.min("file").alias("file")).collect()}
    if None in files:
        heads = scanned_header_lines(spark, path, modified_after)
        files = {r["header"]: [unquote(r["file"])] for r in heads.groupBy("header").agg(F.min("file").alias("file")).collect()}
    if len(files) > 1:
        files = {r["header"]: [unquote(f) for f in r["files"]] for r in heads.groupBy("header").agg(F.collect_list("file").alias("files")).collect()}
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote).option("escape", quote)
    header_reader = reader
    reader = spark.read.options(header=True, sep=sep, quote=quote, escape=quote, columnNameOfCorruptRecord=BROKEN)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    # Spark counts a row's fields only when it parses them all.
    reader = reader.options(mode="FAILFAST" if strict else "PERMISSIVE", columnPruning=not (strict or broken))
    if not files:
        raise ValueError(f"no file with a header: {path}")
    if isinstance(path, str) and not re.search(r"[*?\[{]", path) and is_folder(spark, path):
        reader = reader.option("basePath", path)  # folder names may hold columns
    parts = []
    for header in sorted(files):
        # The header of one of the files, parsed as the reader parses it.
        first = header_reader.csv(sorted(files[header])[0])
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*first.columns, *([BROKEN] if broken else [])]])
        part = reader.schema(schema).csv(path if len(files) == 1 else files[header])
        if file:
            part = part.select("*", *[F.col(f"_metadata.{c}").alias(n) for n, c in FILE_COLUMNS.items()])
        if broken:  # Spark refuses to read that column alone, so another one has a say that is always yes
            part = part.withColumn(BROKEN, F.when(F.coalesce(F.length(f"`{first.columns[0]}`"), F.lit(0)) >= 0, F.col(BROKEN)))
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def count_broken(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """(file, broken): per file the rows that have too few or too many fields."""
    rows = read_text_table(spark, path, sep, broken=True, file=True)
    return rows.groupBy("file").agg(F.count(BROKEN).alias("broken"))


# --- event archives -------------------------------------------------------


def archive_lines(archives: DataFrame) -> DataFrame:
    """(file, line) of the first entry of every zip; ``archives`` has (path) or (path, content).

    A task opens an archive where it lies and unpacks it as a stream of line
    blocks, so it holds one block, whatever the archive's size. With ``content``
    it unpacks those bytes instead.
    """
    held = "content" in archives.columns

    def first_entry_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"] if held else batch["path"]):
                with io.BytesIO(content) if held else _opened(path) as file, zipfile.ZipFile(file) as archive:
                    entries = archive.infolist()
                    if not entries:
                        continue
                    with archive.open(entries[0]) as entry:
                        lines = io.TextIOWrapper(entry, "utf-8")
                        while block := list(itertools.islice(lines, BLOCK_LINES)):
                            yield pd.DataFrame({"file": path, "line": block})

    return archives.select("path", *(["content"] if held else [])).mapInPandas(first_entry_lines, "file string, line string")


class _Stored(io.RawIOBase):
    """A file of any store that pyarrow knows, with Python's own errors."""

    def __init__(self, path: str):
        system, at = stored_at(path)
        self._file = system.open_input_file(at)
        self._size = self._file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        to = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.tell(), io.SEEK_END: self._size}[whence]
        if to < 0:
            raise OSError(f"before the start: {to}")
        self._file.seek(to)
        return to

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        if hasattr(self, "_file"):
            self._file.close()
        super().close()


def _opened(path: str) -> io.BufferedReader:
    return io.BufferedReader(_Stored(path), 1 << 16)


def read_archives(spark: SparkSession, path: str, modified_after: str | None = None, content: bool = False) -> DataFrame:
    """(path) of archives, of any size; ``content`` adds their bytes.

    That is for a store that only Spark can open; an archive then has to be
    below the 2 GB that Spark holds in one binary value.
    """
    reader = spark.read.format("binaryFile")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"), *([F.col("content")] if content else []))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of plain or gzipped JSON-lines files."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def _event_map(lines: DataFrame) -> Column:
    return F.from_json("line", "map<string,variant>")


def _unreadable(m: Column) -> Column:
    return m.isNull() & (F.trim("line") != "")


def count_broken_events(lines: DataFrame) -> DataFrame:
    """(file, broken): per file the lines that are not a JSON object."""
    return lines.groupBy("file").agg(F.count_if(_unreadable(_event_map(lines))).alias("broken"))


def parse_events(lines: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Events of the given names: (file, event_name, event_id, happened_at, payload).

    The three lifted keys leave the payload; all other fields stay, nested ones
    as they are. Equal rows of one file count once. A line that is no JSON
    object is left out (`count_broken_events` counts them); ``strict`` fails on it.
    """
    wide = _event_map(lines)
    if strict:
        wide = F.when(_unreadable(wide), F.raise_error(F.concat(F.lit("not an event: "), F.col("line")))).otherwise(wide)
    text = lambda key: F.col("m")[key].try_cast("string")
    parsed = lines.select("file", wide.alias("m")).where(text("event_name").isin(*names))
    lifted = ("event_name", "event_id", "happened_at")
    body = F.map_filter("m", lambda k, v: ~k.isin(*lifted))
    events = parsed.select(
        "file",
        text("event_name").alias("event_name"),
        text("event_id").alias("event_id"),
        S.parse_instant(text("happened_at"), S.INSTANT_UTC_OFFSET).alias("happened_at"),
        F.to_json(body).alias("payload"),
    )
    return events.dropDuplicates()


def scan_event_archive(archives: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """All wanted events of zip archives in one pass; filter ``event_name`` to fan out."""
    return parse_events(archive_lines(archives), names, strict)


# --- listings -------------------------------------------------------------


def _listing_value(out: str, source: str) -> Column:
    c = F.col(source)
    if out == "dealer_id":
        return S.safe_int(c)
    if out in ("price", "miles", "latitude", "longitude"):
        return S.safe_double(c)
    if out in ("scraped_at", "status_date"):
        return S.parse_instant(c)
    if out == "zip":
        return S.strip_spaces(S.null_if_empty(c))
    if out == "domain":
        return clean_source_domain(c)
    return S.null_if_empty(c)


def typed_listings(raw: DataFrame, profile: str) -> DataFrame:
    """Quality filter of the profile, then the typed listing columns (and ``file`` when present)."""
    keep = [F.col("file")] if "file" in raw.columns else []
    columns = [_listing_value(out, src).alias(out) for out, src in LISTING_COLUMNS]
    return raw.where(LISTING_PROFILES[profile]()).select(*keep, *columns)


def scan_listing_csv(spark: SparkSession, path: str | Sequence[str], profile: str, modified_after: str | None = None) -> DataFrame:
    return typed_listings(read_text_table(spark, path, ",", modified_after, file=True), profile)


def snapshot_versions(spark: SparkSession, path: str, cutoff: Column | None = None, sep: str = ",") -> DataFrame:
    """Every file under ``path`` is one version of the same table; optionally only versions since ``cutoff``."""
    df = read_text_table(spark, path, sep, file=True).drop("block")
    return df if cutoff is None else df.where(F.col("last_modified") >= cutoff)


def column_subset(raw: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Payload of the wanted columns that exist (all columns when none are named)."""
    names = [c for c in wanted if c in raw.columns] if wanted else [c for c in raw.columns if c not in keep]
    return pack_payload(raw.select(*keep, *names), keep)


# --- catalog, sales, keyed files -----------------------------------------


def scan_catalog_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(file, vin_pattern, vehicle_id, payload) of a tab-separated catalog snapshot."""
    raw = read_text_table(spark, path, "\t", file=True)
    lifted = raw.drop("last_modified", "block").withColumnRenamed("VIN_PATTERN", "vin_pattern").withColumnRenamed("VEHICLE_ID", "vehicle_id")
    return pack_payload(lifted.withColumn("vehicle_id", S.safe_int(F.col("vehicle_id"))), ["file", "vin_pattern", "vehicle_id"])


def scan_sales_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(file, payload) of tab-separated sales files."""
    return pack_payload(read_text_table(spark, path, "\t", file=True).drop("last_modified", "block"), ["file"])


def import_keyed_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(id, payload, position) of a CSV with an integer key column; rows without a valid key are dropped."""
    raw = read_text_table(spark, path, file=True)
    raw = raw.withColumn("position", F.struct("file", "block", F.monotonically_increasing_id().alias("n"))).drop(*FILE_COLUMNS)
    keyed = raw.withColumn("id", S.safe_int(F.col(key))).where(F.col("id").isNotNull())
    return pack_payload(keyed.drop(key) if key != "id" else keyed, ["id", "position"])


def scan_all_text(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All-text table of a delimited file; the view name is ``table_name(path)``."""
    return read_text_table(spark, path, sep)


def table_name(path: str) -> str:
    """Lower-case file name without its last extension."""
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return (base.rsplit(".", 1)[0] if "." in base else base).lower()


# --- billing --------------------------------------------------------------


def typed_billing(raw: DataFrame, table: str) -> DataFrame:
    """(id, updateddate, deleted, payload) of an export with ``Table.Column`` headers.

    The deletion flag stays in the payload; id and update time leave it.
    """
    id_, updated, deleted = (f"{table}.{c}" for c in ("Id", "UpdatedDate", "is_deleted"))
    lifted = raw.withColumns(
        {
            "id": F.col(f"`{id_}`"),
            "updateddate": S.parse_instant(F.col(f"`{updated}`"), S.INSTANT_ANY_OFFSET),
            "deleted": F.col(f"`{deleted}`"),
        }
    )
    rest = [F.col(f"`{c}`") for c in lifted.columns if c not in (id_, updated)]
    return pack_payload(lifted.select(*rest), ["id", "updateddate", "deleted"])


def scan_billing_export(spark: SparkSession, path: str, table: str) -> DataFrame:
    return typed_billing(read_text_table(spark, path), table)


# --- sectioned reports ----------------------------------------------------

# Line numbers of the report layout.
TITLE_LINE, HEADER_LINE = 2, 8


def report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, line) with ``at`` ordering the lines of a file across its splits."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), at.alias("at"), F.col("value").alias("line"))


def parse_sectioned_report(lines: DataFrame) -> DataFrame:
    """(dealer, purchase_number, purchase_date, payload, at) from reports in the fixed layout.

    The title line names the dealer, the header line the fields; data runs from
    there to the first blank line. Only the top lines of each file are ranked.
    """
    rank = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    top = lines.withColumn("_no", rank).where(F.col("_no") <= HEADER_LINE)
    head = top.groupBy("file").agg(
        F.max(F.when(F.col("_no") == TITLE_LINE, F.split("line", ",")[0])).alias("dealer"),
        F.max(F.when(F.col("_no") == HEADER_LINE, F.col("line"))).alias("_names"),
        F.max(F.when(F.col("_no") == HEADER_LINE, F.col("at"))).alias("_start"),
    )
    body = spread_join(lines, head, ["file"], salts=SALTS, null_safe=False).where(F.col("at") > F.col("_start"))
    ends = body.where(F.col("line") == "").groupBy("file").agg(F.min("at").alias("_end"))
    data = left_lookup(body.withColumn("_file", F.col("file")), ends, "_file", "file").where(F.col("_end").isNull() | (F.col("at") < F.col("_end")))
    values = F.split("line", ",", -1)
    names = F.split("_names", ",", -1)
    first = F.split(values[0], " ")
    rest = lambda c: F.slice(c, F.lit(2), F.size(c))
    fields = F.arrays_zip(rest(names).alias("k"), F.transform(rest(values), S.strip_currency).alias("v"))
    fields = F.filter(fields, lambda e: e["k"].isNotNull() & e["v"].isNotNull())
    return data.select(
        "dealer",
        S.safe_int(F.get(first, F.lit(0))).alias("purchase_number"),
        S.parse_instant(F.get(first, F.lit(2)), S.DATE_US).alias("purchase_date"),
        F.to_json(F.map_from_entries(fields)).alias("payload"),
        F.struct("file", "at").alias("at"),
    )


def scan_sectioned_report(spark: SparkSession, path: str) -> DataFrame:
    """The files are opened once; the passes over the lines read what was written of them."""
    return parse_sectioned_report(materialize(report_lines(spark, path), "lines"))
