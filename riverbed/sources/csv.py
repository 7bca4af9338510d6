"""Delimited-file sources.

* ``CsvFormat``: the reusable parse options of a file format object (A1).
* ``positional_schema`` + ``pick``: read every field as text by position and
  keep only the ones a target needs (A3).
* ``numbered_records``: the records of files that are read in splits, quoted
  line breaks included, each with its 1-based number in its file (A1, A4).
* ``read_numbered``: fields and row numbers of files; the reader's own
  multi-line mode where a format cannot be split.
* ``read_landing``: batch read of a folder into a raw landing shape (A9).
* ``file_inventory``: ``LIST @stage`` (A13).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbed.functions.parse import NULL_TOKENS, ntz, null_if_tokens
from riverbed.session import shared_listing

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CsvFormat:
    """A1: comma, one header line, optional double quotes (a doubled quote
    inside), unquoted spaces trimmed, several NULL tokens, invalid UTF-8
    replaced by U+FFFD (the UTF-8 decoder's own behaviour). ``multiline``
    keeps a quoted newline inside one record. Such files are read in splits
    (``numbered_records``) unless ``splittable`` is off or the format has an
    escape of its own, another encoding or reader options (``extra``); then the
    reader's multi-line mode takes each file as one task."""

    delimiter: str = ","
    header: bool = True
    quote: str = '"'
    escape: str = '"'
    trim_space: bool = True
    null_tokens: tuple[str, ...] = NULL_TOKENS
    multiline: bool = True
    encoding: str = "UTF-8"
    extra: Mapping[str, str] = field(default_factory=dict)
    splittable: bool = True

    @property
    def in_splits(self) -> bool:
        return (self.splittable and self.multiline and self.escape == self.quote and not self.extra
                and self.encoding.upper() == "UTF-8" and len(self.delimiter) == len(self.quote) == 1)

    def options(self) -> dict[str, str]:
        opts = {
            "sep": self.delimiter, "header": str(self.header).lower(), "quote": self.quote,
            "escape": self.escape, "ignoreLeadingWhiteSpace": str(self.trim_space).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim_space).lower(),
            "multiLine": str(self.multiline).lower(), "encoding": self.encoding,
            "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
            "enforceSchema": "true",
        }
        opts.update(self.extra)
        return opts


def positional_schema(n_fields: int, corrupt: bool = True) -> T.StructType:
    """``c1..cN`` as text (+ the corrupt-record column that flags rows with
    too few or too many fields)."""
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(1, n_fields + 1)]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def pick(df: DataFrame, positions: Mapping[str, int], fmt: CsvFormat) -> list[Column]:
    """A3 + A1: ``$n AS name`` with the NULL tokens normalised."""
    return [null_if_tokens(F.col(f"c{p}"), fmt.null_tokens).alias(name)
            for name, p in positions.items()]


def utc_time(ts: Column) -> Column:
    """An instant as zone-free UTC time, whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), ts.cast("timestamp_ntz"))


def file_columns() -> list[Column]:
    """File lineage of each row (A4): path, size, modification time."""
    return [F.col("_metadata.file_path").alias("meta_filename"),
            F.col("_metadata.file_size").alias("_file_size"),
            utc_time(F.col("_metadata.file_modification_time")).alias("_file_mtime")]


def read_text_table(spark: SparkSession, path: str | Sequence[str], n_fields: int, fmt: CsvFormat) -> DataFrame:
    """Every field as text by position, plus file lineage and the raw text
    of malformed rows, by the CSV reader."""
    reader = spark.read.schema(positional_schema(n_fields)).options(**fmt.options())
    with shared_listing(spark):
        rows = reader.csv(path if isinstance(path, str) else list(path))
    return rows.select("*", *file_columns())


def with_file_row_number(df: DataFrame, file_col: str = "meta_filename",
                         out: str = "meta_file_row_number") -> DataFrame:
    """A4: 1-based row number inside each file, in file order, of the rows of
    a file scan.

    A block of a file (``_metadata.file_block_start``) is read by one task, in
    order, so a row's place in it is its id less the block's least id, whatever
    task that is. Per block one small row (least id, rows) is aggregated, the
    rows of a file's earlier blocks are summed, and the sum is joined back, by
    broadcast only while Spark finds it small. The files are read twice; no row
    is shuffled or copied for its number."""
    ids = df.withColumns({"_mid": F.monotonically_increasing_id(), "_block": F.col("_metadata.file_block_start")})
    blocks = ids.groupBy(file_col, "_block").agg(F.min("_mid").alias("_bmin"), F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(file_col).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_bn").over(w), F.lit(0)))
    joined = ids.join(blocks, [file_col, "_block"])
    return joined.withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_bmin") + 1).cast("bigint")) \
                 .drop("_mid", "_block", "_bmin", "_bn", "_off")


def with_small_file_row_number(df: DataFrame, file_col: str = "meta_filename",
                               out: str = "meta_file_row_number") -> DataFrame:
    """``with_file_row_number`` for files of at most a split each: the rows of a
    file meet and are counted in their order. No group is larger than a split,
    and the files, whose opening is what costs when they are many, are read once."""
    ids = df.withColumns({"_mid": F.monotonically_increasing_id(), "_block": F.col("_metadata.file_block_start")})
    in_file = Window.partitionBy(file_col).orderBy("_block", "_mid")
    return ids.withColumn(out, F.row_number().over(in_file).cast("bigint")).drop("_mid", "_block")


# -- quoted line breaks in splits ----------------------------------------------------
def quote_state(line: str, inside: bool, sep: str, quote: str, trim: bool) -> bool:
    """Whether a quoted field is open after the line, given whether one was
    before it. A quote opens a field only at its start; a quote that neither is
    doubled nor ends the field makes the rest of it plain text, as in Spark's
    reader."""
    i, n, line = 0, len(line.rstrip("\r")), line.rstrip("\r")
    while True:
        if not inside:
            if trim:
                while i < n and line[i] in " \t":
                    i += 1
            inside = i < n and line[i] == quote
            i += inside
        while inside:
            i = line.find(quote, i)
            if i < 0:
                return True
            if line.startswith(quote, i + 1):
                i += 2
                continue
            i += 1
            inside = False
        i = line.find(sep, i)
        if i < 0:
            return False
        i += 1


class QuoteScan:
    """The quote states of a block's lines, for both states it can begin in."""

    def __init__(self, fmt: CsvFormat):
        self.sep, self.quote, self.trim = fmt.delimiter, fmt.quote, fmt.trim_space
        q, s = (("\\" + c if c in "\\^$.|?*+()[]{}" else c) for c in (fmt.quote, fmt.delimiter))
        f = f"(?:{q}(?:[^{q}]|{q}{q})*{q}|[^{q}{s}]*)"
        self.closed = f"^{f}(?:{s}{f})*\r?$"  # a line of whole fields
        self.begin()

    def begin(self) -> None:
        self.states, self.records, self.lines = [False, True], [0, 0], 0

    def add(self, column: pa.Array) -> dict[str, np.ndarray]:
        """Per line: its place in the block and, for each state k that the
        block may begin in, whether a quoted field is open before and after it
        (b<k>, a<k>) and the records begun so far (r<k>)."""
        n = len(column)
        quotes = pc.count_substring(column, self.quote).to_numpy(zero_copy_only=False)
        odd = quotes % 2 == 1
        # What a line does to the state: it stays, flips, or becomes fixed.
        flip, fixed, value = odd.copy(), np.zeros(n, bool), np.zeros(n, bool)
        some = np.flatnonzero(quotes > 0)
        if len(some):
            plain = pc.match_substring_regex(column.take(pa.array(some)), self.closed).to_numpy(zero_copy_only=False)
            for i in some[~plain | odd[some]].tolist():
                line = column[i].as_buffer().to_pybytes().decode("utf-8", "replace")
                after = [quote_state(line, k, self.sep, self.quote, self.trim) for k in (False, True)]
                fixed[i] = after[0] == after[1]
                value[i] = after[0]
                flip[i] = after[0] and not after[1]
        blank = (pc.utf8_length(pc.ascii_trim_whitespace(column)).to_numpy(zero_copy_only=False) == 0)
        flips = np.cumsum(flip & ~fixed)
        last = np.maximum.accumulate(np.where(fixed, np.arange(n), -1)) if n else np.zeros(0, np.int64)
        out = {"line": self.lines + np.arange(n, dtype=np.int64)}
        for k in (0, 1):
            seen = np.where(last >= 0, value[last], self.states[k])
            since = flips - np.where(last >= 0, flips[last], 0)
            after = seen ^ (since % 2 == 1)
            before = np.r_[self.states[k], after[:-1]][:n].astype(bool)
            out[f"a{k}"], out[f"b{k}"] = after, before
            out[f"r{k}"] = self.records[k] + np.cumsum(~before & ~blank)
            if n:
                self.states[k], self.records[k] = bool(after[-1]), int(out[f"r{k}"][-1])
        self.lines += n
        return out


_SCAN = "meta_filename string, block bigint, value string, line bigint, " \
        "a0 boolean, b0 boolean, r0 bigint, a1 boolean, b1 boolean, r1 bigint"


def numbered_records(spark: SparkSession, path: str | Sequence[str], fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """(meta_filename, record, number): the records of delimited files that are
    read in splits, also where quoted fields hold line breaks.

    Whether a quoted field is open where a split begins depends on all text
    before it. So each task scans its split's lines for both answers (numpy over
    Arrow batches); one small row per split then says where each answer leads,
    a fold over a file's splits in order settles which one holds and how many
    records began before, and the lines take it by a join on (file, split).
    Lines that are whole records go on as they are, unshuffled; only the pieces
    of records with line breaks meet, by (file, record number). A file of many
    splits is read by as many tasks; the files are read twice.

    Blank lines between records are skipped, ``\\r\\n`` counts as a line break
    and becomes ``\\n`` inside a field, as in the reader's multi-line mode."""
    with shared_listing(spark):
        text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    lines = (text
             .select(F.col("_metadata.file_path").alias("meta_filename"),
                     F.col("_metadata.file_block_start").alias("block"), "value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, now = QuoteScan(fmt), None
        for b in batches:
            if not b.num_rows:
                continue
            name, block = b.column("meta_filename"), b.column("block").to_numpy()
            fresh = np.r_[True, (block[1:] != block[:-1])
                          | pc.not_equal(name.slice(1), name.slice(0, len(name) - 1)).to_numpy(zero_copy_only=False)]
            cuts = [*np.flatnonzero(fresh).tolist(), b.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(lo, hi - lo)
                at = (part.column("meta_filename")[0].as_py(), int(block[lo]))
                if at != now:
                    now = at
                    scan.begin()
                found = scan.add(part.column("value"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("meta_filename"), part.column("block"), part.column("value"),
                     *[pa.array(found[c]) for c in ("line", "a0", "b0", "r0", "a1", "b1", "r1")]],
                    ["meta_filename", "block", "value", "line", "a0", "b0", "r0", "a1", "b1", "r1"])

    scanned = lines.mapInArrow(run, _SCAN)
    ends = (scanned.groupBy("meta_filename", "block")
            .agg(F.max_by(F.struct("a0", "r0", "a1", "r1"), "line").alias("e"))
            .groupBy("meta_filename").agg(F.sort_array(F.collect_list(F.struct("block", "e"))).alias("s")))
    # Splits in order: (block, open, records before), from the state the one before leaves.
    starts = ends.select("meta_filename", F.explode(F.expr("""aggregate(s,
        struct(CAST(array() AS array<struct<block:bigint,open:boolean,before:bigint>>) AS done,
               false AS open, 0L AS before),
        (x, b) -> struct(concat(x.done, array(struct(b.block AS block, x.open AS open, x.before AS before))) AS done,
                         IF(x.open, b.e.a1, b.e.a0) AS open,
                         x.before + IF(x.open, b.e.r1, b.e.r0) AS before),
        x -> x.done)""")).alias("b")).select("meta_filename", "b.*")
    told = (scanned.join(starts, ["meta_filename", "block"])
            .select("meta_filename", "block", "line", "value",
                    F.when(F.col("open"), F.col("b1")).otherwise(F.col("b0")).alias("inside"),
                    F.when(F.col("open"), F.col("a1")).otherwise(F.col("a0")).alias("goes_on"),
                    (F.col("before") + F.when(F.col("open"), F.col("r1")).otherwise(F.col("r0"))).alias("number"))
            .filter(F.col("inside") | (F.trim(F.translate("value", "\t\r", "  ")) != "")))
    whole = (told.filter("NOT inside AND NOT goes_on")
             .select("meta_filename", F.col("value").alias("record"), "number"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    joined = (told.filter("inside OR goes_on").groupBy("meta_filename", "number").agg(pieces.alias("p"))
              .select("meta_filename", F.array_join("p.value", "\n").alias("record"), "number"))
    records = whole.unionByName(joined)
    return records.withColumn("record", F.replace(F.rtrim(F.col("record"), F.lit("\r")),
                                                  F.lit("\r\n"), F.lit("\n")))


def split_bytes(spark: SparkSession) -> int:
    """Size from which Spark may cut a file into several splits."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if unit else text) << unit


def read_numbered(spark: SparkSession, path: str | Sequence[str], n_fields: int,
                  fmt: CsvFormat = CsvFormat(), largest: int | None = None) -> DataFrame:
    """Every field as text by position, the raw text of malformed rows, the
    file's name and the row's number in it (header not counted). Files that are
    one split each are a task each in either way, and the reader's multi-line
    mode is then the cheaper one, read once; a ``largest`` file of more (None:
    listed) takes the way in splits."""
    fields = [f.name for f in positional_schema(n_fields)]
    if largest is None:
        files = file_inventory(spark, path if isinstance(path, str) else list(path), None)
        largest = files.agg(F.max("size")).first()[0] or 0
    small = largest <= split_bytes(spark)
    if small or not fmt.in_splits:
        number = with_small_file_row_number if small else with_file_row_number
        return (number(read_text_table(spark, path, n_fields, fmt))
                .select(*fields, "meta_filename", "meta_file_row_number"))
    drop = ("header", "multiLine", "encoding", "enforceSchema")
    options = {k: v for k, v in fmt.options().items() if k not in drop}
    records = numbered_records(spark, path, fmt)
    if fmt.header:
        records = records.filter("number > 1").withColumn("number", F.col("number") - 1)
    parsed = F.from_csv("record", positional_schema(n_fields).simpleString()[7:-1].replace(":", " "), options)
    return (records.select(parsed.alias("r"), "meta_filename", F.col("number").alias("meta_file_row_number"))
            .select("r.*", "meta_filename", "meta_file_row_number"))


def read_landing(spark: SparkSession, path: str | Sequence[str], n_fields: int, positions: Mapping[str, int],
                 load_ts, fmt: CsvFormat = CsvFormat()) -> DataFrame:
    """A9 batch form: the raw landing shape (text columns + file name, row
    number and one load time for the whole batch)."""
    numbered = read_numbered(spark, path, n_fields, fmt)
    return numbered.select(*pick(numbered, positions, fmt), "meta_filename", "meta_file_row_number",
                           ntz(load_ts).alias("meta_load_ts"))


def file_inventory(spark: SparkSession, path: str | list[str], glob: str | None = "*.csv") -> DataFrame:
    """Name, size and modification time of every file (the content
    column is pruned, so no file body is read), and ``meta_filename``, the name
    as the rows of the file carry it."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    with shared_listing(spark):
        files = reader.load(path)
    return (files
            .select(F.col("path").alias("name"), F.col("length").alias("size"),
                    utc_time(F.col("modificationTime")).alias("last_modified"),
                    F.col("_metadata.file_path").alias("meta_filename")))


def write_text_csv(df: DataFrame, path: str, keep_spaces: bool = True, header: bool = True) -> None:
    """Write text columns as CSV (sources for the ingest tests and examples)."""
    (df.write.option("header", header).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", not keep_spaces)
       .option("ignoreTrailingWhiteSpace", not keep_spaces)
       .option("nullValue", "").option("emptyValue", '""').csv(path))


def default_positions(names: Sequence[str]) -> dict[str, int]:
    return {n: i for i, n in enumerate(names, start=1)}
