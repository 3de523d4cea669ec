"""Delimited-text sources: discovery, header handling, positional or by-name alignment.

Every value is read as text (schema enforced, no inference).  The file listing and
the header lines are the only things the driver sees: data rows stay in the scan.
"""

from __future__ import annotations

import codecs
import csv as _pycsv
import io
import posixpath
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertfold.functions.names import EXCLUDE_OUTPUTS, EXCLUDE_PARTS
from alertfold.functions.text import repair_mojibake, repair_mojibake_name, strip_accents_name
from alertfold.operators.order import ORDER_COL, path_key, path_sort_key, with_file_order
from alertfold.operators.small import per_file_broadcast

CORRUPT = "_corrupt_record"
# Largest file list written into a scan's plan as a path predicate (larger lists go
# to the file index, so task binaries stay small).
MAX_PATH_PREDICATE = 10_000
# Distinct headers up to which each has a scan of its own
MAX_HEADER_SCANS = 8
SOURCE = "_src"     # file name
PATH = "_path"      # full file path (the file identity)

# Text that a default pandas read turns into a missing value.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")


class NoSourceFiles(FileNotFoundError):
    """No file left after discovery and filtering."""


@dataclass(frozen=True)
class CsvOptions:
    sep: str = ";"
    encoding: str = "UTF-8"
    recursive: bool = True
    glob: str = "*.[cC][sS][vV]"                 # case-insensitive .csv suffix
    exclude: Sequence[str] = (*EXCLUDE_OUTPUTS, EXCLUDE_PARTS)  # file-name regexes, case-insensitive
    include: str | None = None                   # file-name regex, case-insensitive
    multiline: bool = False                      # quoted newlines (stops file splitting)
    header_from: str = "path_max"                # or "mtime": most recently modified file
    na_tokens: bool = True                       # NA spellings -> NULL (else '' kept as '')
    header_fix: str | None = None                # None | "mojibake" | "accents"
    repair_values: bool = False                  # also repair mojibake in values
    extra: dict = field(default_factory=dict)

    def reader(self, spark: SparkSession):
        r = (spark.read.option("sep", self.sep).option("encoding", self.encoding)
             .option("escape", '"').option("multiLine", self.multiline)
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
        for k, v in self.extra.items():
            r = r.option(k, v)
        return r


# ---------------------------------------------------------------- discovery
def name_allowed(name: str, opts: CsvOptions) -> bool:
    if any(re.search(p, name, flags=re.IGNORECASE) for p in opts.exclude):
        return False
    if opts.include and not re.search(opts.include, name, flags=re.IGNORECASE):
        return False
    return True


def listing(spark: SparkSession, root: str | Sequence[str], opts: CsvOptions = CsvOptions()) -> DataFrame:
    """Files under ``root`` as a DataFrame (path, name, modification time, length);
    the binary-file source lists without reading contents when ``content`` is not selected."""
    roots = [root] if isinstance(root, str) else list(root)
    df = (spark.read.format("binaryFile").option("pathGlobFilter", opts.glob)
          .option("recursiveFileLookup", opts.recursive).load(roots))
    return df.select("path", unescape(F.element_at(F.split("path", "/"), -1)).alias("file_name"),
                     F.col("modificationTime").alias("mtime"), "length")


def discover(spark: SparkSession, root: str | Sequence[str], opts: CsvOptions = CsvOptions()) -> list[str]:
    """Sorted source paths after the glob, exclusion and inclusion rules."""
    from pyspark.errors import AnalysisException
    roots = [root] if isinstance(root, str) else list(root)
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", opts.glob)
                 .option("recursiveFileLookup", opts.recursive).load(roots).inputFiles())
    except AnalysisException as e:
        raise NoSourceFiles(f"no source folder {roots}: {e}") from e
    kept = sorted((hadoop_path(p) for p in files if name_allowed(unquote(posixpath.basename(p)), opts)),
                  key=path_sort_key)
    if not kept:
        raise NoSourceFiles(f"no source file under {roots}")
    return kept


def hadoop_path(path: str) -> str:
    """The spelling ``_metadata.file_path`` uses (local files: 'file:/x', not 'file:///x')."""
    if path.startswith("file:///"):
        return "file:/" + path[len("file:///"):]
    return path


_GLOB_CHARS = re.compile(r"([\\\[\]{}*?])")


def reader_path(path: str) -> str:
    """A discovered path, spelled as ``_metadata.file_path`` spells it (URI escapes such
    as ``%20``), as a literal path for ``spark.read``: escapes decoded, glob characters
    quoted (the reader expands globs in the paths it is given)."""
    return _GLOB_CHARS.sub(r"\\\1", unquote(path))


def unescape(c: Column) -> Column:
    """URI-escaped path text ('x%20y.csv') as on disk; '+' is protected first, since URL
    decoding would read it as a space."""
    decoded = F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    return F.when(c.contains("%"), decoded).otherwise(c)   # most names need no decoding


def file_name() -> Column:
    """The source file's name as on disk (``_metadata.file_name`` is URI-escaped)."""
    return unescape(F.col("_metadata.file_name"))


# ---------------------------------------------------------------- headers
# Hadoop scheme -> the name Arrow's file systems use
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _arrow_uri(path: str) -> str:
    """A discovered path as a URI Arrow parses: 'file:/x' -> 'file:///x', Hadoop-only
    scheme names mapped, every non-ASCII or reserved character percent-escaped."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    scheme, sep, rest = path.partition("://")
    if not sep:
        return path
    return f"{_ARROW_SCHEMES.get(scheme, scheme)}://" + quote(unquote(rest), safe="/:@")


_ARROW_FS: dict[str, tuple] = {}


def _arrow_open(path: str):
    """(file system, path inside it); one file system per scheme and authority and per
    process, since resolving one may cost a remote call (an S3 bucket's region)."""
    from pyarrow import fs as pafs
    uri = _arrow_uri(path)
    scheme, _, rest = uri.partition("://")
    authority, _, local = rest.partition("/")
    local = unquote("/" + local)
    key = f"{scheme}://{authority}"
    if key not in _ARROW_FS:
        filesystem, inner = pafs.FileSystem.from_uri(uri)
        _ARROW_FS[key] = (filesystem, inner[: len(inner) - len(local)])   # e.g. 'bucket' for S3
    filesystem, prefix = _ARROW_FS[key]
    return filesystem, prefix + local


def first_line(path: str, encoding: str) -> str | None:
    """First non-blank line of a file, reading only its first bytes (Arrow file systems)."""
    filesystem, inner = _arrow_open(path)
    buf, done = b"", []
    with filesystem.open_input_stream(inner) as f:
        while True:
            chunk = f.read(1 << 16)
            buf += chunk
            lines = buf.split(b"\n")
            done = [ln for ln in lines[:-1] if ln.strip(b"\r\t ")]
            if done or not chunk:
                break
    cand = done[0] if done else (buf if buf.strip() else None)
    if cand is None:
        return None
    if cand.startswith(b"\xef\xbb\xbf"):
        cand = cand[3:]   # a UTF-8 byte-order mark, whatever the declared encoding
    return cand.rstrip(b"\r").decode(encoding, errors="replace")


def _first_lines(encoding: str):
    """Per-partition function over a file list: (path, first line, read).  A file Arrow
    cannot open is reported with read=False instead of failing the task."""

    def run(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                try:
                    out.append((p, first_line(p, encoding), True))
                except (OSError, ValueError):    # not found, no access, unparsable URI
                    out.append((p, None, False))
            yield pd.DataFrame(out, columns=["path", "line", "read"])

    return run


def header_lines(spark: SparkSession, files: Sequence[str], opts: CsvOptions, method: str = "auto",
                 skip_corrupt: bool = False) -> DataFrame:
    """(path, line): the first non-blank line of every file, decoded with the file encoding.

    method='arrow': the file list is spread over tasks and each task opens its files
    and reads only their first bytes, so the cost is one short read per file however
    large the files are.  method='scan': a single-column text scan keeping the first
    line of each file (reads every byte; for file systems Arrow cannot open).
    """
    if method == "auto":
        method = "arrow" if _arrow_can_open(files[0] if files else "") else "scan"
    if method == "arrow":
        out = _arrow_lines(spark, files, opts)
        return out.where(F.col("read") & F.col("line").isNotNull()).select("path", "line")
    raw = (spark.read.schema("line string").option("sep", "\u0001").option("quote", "")
           .option("encoding", opts.encoding).option("header", False)
           .option("ignoreCorruptFiles", skip_corrupt).csv([reader_path(p) for p in files]))
    return (raw.where(F.col("_metadata.file_block_start") == 0)
            .select(F.col("_metadata.file_path").alias("path"), "line",
                    F.monotonically_increasing_id().alias("__pos"))
            .groupBy("path").agg(F.min_by("line", "__pos").alias("line")))


def _paths_frame(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """The driver's file list as a one-column DataFrame, sent as one Arrow batch (a
    million paths: about 5 s instead of 13 s row by row)."""
    import pandas as pd
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        return spark.createDataFrame(pd.DataFrame({"path": pd.Series(list(files), dtype=object)}), "path string")
    finally:
        spark.conf.set(key, before)


def _arrow_lines(spark: SparkSession, files: Sequence[str], opts: CsvOptions) -> DataFrame:
    n = max(1, min(len(files) // 64 + 1, spark.sparkContext.defaultParallelism * 4))
    paths = _paths_frame(spark, files).repartition(n)
    return paths.mapInPandas(_first_lines(_py_encoding(opts.encoding)), "path string, line string, read boolean")


def collect_header_lines(spark: SparkSession, files: Sequence[str], opts: CsvOptions) -> list[tuple[str, str]]:
    """(path, first line) of every non-empty file, on the driver: one short row per file.
    Short reads through Arrow; only the files Arrow could not open are scanned."""
    if not files:
        return []
    if not _arrow_can_open(files[0]):
        return [(r["path"], r["line"]) for r in header_lines(spark, files, opts, method="scan").collect()]
    got = _arrow_lines(spark, files, opts).collect()
    lines = [(r["path"], r["line"]) for r in got if r["read"] and r["line"] is not None]
    failed = [r["path"] for r in got if not r["read"]]
    if failed:
        lines += [(r["path"], r["line"]) for r in header_lines(spark, failed, opts, method="scan").collect()]
    return lines


# ---------------------------------------------------------------- first values
HEAD_BYTES = 1 << 16


def head_lines(path: str, encoding: str, size: int = HEAD_BYTES) -> tuple[list[str], bool]:
    """The complete non-blank lines in a file's first bytes, and whether that is all of it."""
    filesystem, inner = _arrow_open(path)
    buf = b""
    with filesystem.open_input_stream(inner) as f:
        while len(buf) <= size and (chunk := f.read(size + 1 - len(buf))):
            buf += chunk
    whole = len(buf) <= size
    if not whole:
        buf = buf[:buf.rfind(b"\n") + 1]
    text = buf.removeprefix(b"\xef\xbb\xbf").decode(encoding, errors="replace")
    return [line.rstrip("\r") for line in text.split("\n") if line.strip()], whole


def _first_values(opts: CsvOptions, size: int):
    def run(batches):
        import pandas as pd
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    lines, whole = head_lines(path, _py_encoding(opts.encoding), size)
                except (OSError, ValueError):
                    out.append((path, None, None, False))
                    continue
                names = split_header(lines[0], opts) if lines else []
                first: list[str | None] = [None] * len(names)
                for line in lines[1:]:
                    if None not in first:
                        break
                    cells = next(_pycsv.reader([line], delimiter=opts.sep, quotechar='"'), [])
                    for i, cell in enumerate(cells[:len(first)]):
                        if first[i] is None and not (cell in NA_TOKENS if opts.na_tokens else False):
                            first[i] = cell
                out.append((path, names, first, whole))
            yield pd.DataFrame(out, columns=["path", "names", "first", "whole"])

    return run


def first_values(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions(),
                 size: int = HEAD_BYTES) -> DataFrame:
    """``path, names, first, whole``: per file its column names and the first non-missing value of
    each column within its first ``size`` bytes (NULL where there is none), by one short read in
    a task; ``whole`` says that the bytes are the file.  Files that cannot be opened that way
    have NULL names."""
    n = max(1, min(len(files) // 64 + 1, spark.sparkContext.defaultParallelism * 4))
    return (_paths_frame(spark, files).repartition(n)
            .mapInPandas(_first_values(opts, size), "path string, names array<string>, first array<string>, whole boolean"))


# ---------------------------------------------------------------- failure ledger
# What the ledger says of a file that gives no rows
UNREADABLE, EMPTY, UNDECODABLE = "unreadable", "empty", "undecodable"
LEDGER_CHUNK = 1 << 20


def file_problem(path: str, encoding: str, whole: bool) -> str | None:
    """Why a file cannot be read, or None: opened and decoded strictly up to its first text, or
    to its end if ``whole``.  Memory is bounded by a chunk."""
    blank = True
    try:
        filesystem, inner = _arrow_open(path)
        with filesystem.open_input_stream(inner) as f:
            decoder = codecs.getincrementaldecoder(encoding)("strict")
            while chunk := f.read(LEDGER_CHUNK):
                text = decoder.decode(chunk)
                blank = blank and not text.strip()
                if not (whole or blank):
                    return None
            blank = blank and not decoder.decode(b"", final=True).strip()
    except UnicodeDecodeError:
        return UNDECODABLE
    except (OSError, ValueError):   # not found, no access, a folder, an unparsable URI
        return UNREADABLE
    return EMPTY if blank else None


def _problems(encoding: str, whole: bool):
    def run(batches):
        import pandas as pd
        for pdf in batches:
            out = [(p, file_problem(p, encoding, whole)) for p in pdf["path"]]
            yield pd.DataFrame([x for x in out if x[1]], columns=["path", "error"])

    return run


def failed_files(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions(),
                 whole: bool = False) -> DataFrame:
    """The failure ledger: ``path, error`` for each file that cannot be opened, has no text, or
    does not decode in the declared encoding.  The files are opened in tasks, one short read
    each (``whole``: read to the end, for bytes that fail later).  File systems Arrow cannot
    open are scanned with unreadable files left out; what gives no line there is told as
    unreadable, replacement characters as undecodable."""
    if files and not _arrow_can_open(files[0]):
        lines = header_lines(spark, files, opts, method="scan", skip_corrupt=True)
        known = _paths_frame(spark, files).join(lines.withColumnRenamed("path", "seen"), F.col("path") == F.col("seen"), "left")
        error = F.when(F.col("line").isNull(), F.lit(UNREADABLE)).when(F.col("line").contains("\ufffd"), F.lit(UNDECODABLE))
        return known.select("path", error.alias("error")).where(F.col("error").isNotNull())
    n = max(1, min(len(files) // 64 + 1, spark.sparkContext.defaultParallelism * 4))
    return (_paths_frame(spark, files).repartition(n)
            .mapInPandas(_problems(_py_encoding(opts.encoding), whole), "path string, error string"))


def split_failed(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions(),
                 whole: bool = False) -> tuple[list[str], dict[str, str]]:
    """The files that can be read, and the ledger of the others (one short entry per failed
    file, of a list the driver holds anyway)."""
    failed = {r["path"]: r["error"] for r in failed_files(spark, files, opts, whole).collect()}
    return [p for p in files if p not in failed], failed


def _py_encoding(enc: str) -> str:
    return {"UTF-8": "utf-8-sig", "utf-8": "utf-8-sig"}.get(enc, enc)


def _arrow_can_open(path: str) -> bool:
    try:
        _arrow_open(path)
        return True
    except Exception:  # noqa: BLE001 - unknown scheme or missing client: use the scan
        return False


def split_header(line: str, opts: CsvOptions) -> list[str]:
    """Header text -> trimmed, repaired, unique column names."""
    line = line.lstrip("\ufeff")
    cells = next(_pycsv.reader(io.StringIO(line), delimiter=opts.sep, quotechar='"'), [])
    names = []
    for c in cells:
        c = c.strip()
        if opts.header_fix == "mojibake":
            c = repair_mojibake_name(c)
        elif opts.header_fix == "accents":
            c = strip_accents_name(c)
        names.append(c.lstrip("\ufeff"))
    return distinct_names(mangle(names))


# Names that differ only in case are one column to Spark.  The later ones carry invisible marks
# through scan, union and write, where the writer takes them off again.
CASE_MARK = "\u2060"


def distinct_names(names: Sequence[str]) -> list[str]:
    """Names that stay distinct when case is ignored: 'Date', 'date' + mark."""
    seen: set[str] = set()
    out = []
    for n in names:
        while n.lower() in seen:
            n += CASE_MARK
        seen.add(n.lower())
        out.append(n)
    return out


def display_name(name: str) -> str:
    """A column's name as the source file has it."""
    return name.rstrip(CASE_MARK)


def mangle(names: Sequence[str]) -> list[str]:
    """Make names unique the way a pandas read does: 'a', 'a.1', 'a.2' ..."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            cand = f"{n}.{seen[n]}"
            while cand in seen:
                seen[n] += 1
                cand = f"{n}.{seen[n]}"
            out.append(cand)
            seen[cand] = 0
        else:
            seen[n] = 0
            out.append(n)
    return out


def reference_header(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions()) -> list[str]:
    """Names of the reference file: last path in sorted order, or most recent by mtime."""
    if opts.header_from == "mtime":
        ref = (listing(spark, [reader_path(p) for p in files], opts)
               .agg(F.max_by("path", F.struct("mtime", path_key(F.col("path")).alias("key"))).alias("p")).first()["p"])
    else:
        ref = max(files, key=path_sort_key)
    line = None
    if _arrow_can_open(ref):
        try:
            line = first_line(ref, _py_encoding(opts.encoding))   # one short read on the driver
        except (OSError, ValueError):
            line = header_lines(spark, [ref], opts, method="scan").first()
            line = line["line"] if line else None
    else:
        row = header_lines(spark, [ref], opts, method="scan").first()
        line = row["line"] if row else None
    if line is None:
        raise NoSourceFiles(f"reference file {ref} is empty")
    return split_header(line, opts)


def _string_schema(names: Sequence[str], corrupt: bool = True) -> T.StructType:
    fields = [T.StructField(n, T.StringType(), True) for n in names]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType(), True))
    return T.StructType(fields)


def na_to_null(c: Column) -> Column:
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _finish(df: DataFrame, names: Sequence[str], opts: CsvOptions) -> DataFrame:
    cols = []
    for n in names:
        c = F.col(f"`{n}`")
        if opts.repair_values:
            c = repair_mojibake(c)
        c = na_to_null(c) if opts.na_tokens else F.coalesce(c, F.lit(""))
        cols.append(c.alias(n))
    return df.select(*cols, *[F.col(x) for x in df.columns if x not in names])


def cell_count(line: Column, sep: str) -> Column:
    """Number of cells of a raw CSV line (quoted sections ignored)."""
    unquoted = F.regexp_replace(line, r'"([^"]|"")*"', "")
    return F.size(F.split(unquoted, re.escape(sep))) if sep else F.lit(1)


# ---------------------------------------------------------------- scans
def read_positional(spark: SparkSession, files: Sequence[str], header: Sequence[str],
                    opts: CsvOptions = CsvOptions(), name_filter=None) -> DataFrame:
    """Every file mapped to ``header`` by position: each file's own header line is
    skipped, extra cells are dropped, missing cells are NULL.  Adds ``_src`` (file
    name), ``_ord`` (input order) and ``_cells`` (cell count when it differs from the
    header, else NULL)."""
    reader = opts.reader(spark).schema(_string_schema(header)).option("header", True)
    if name_filter is not None:   # ``files`` are roots: list them with the glob, prune by name
        df = (reader.option("pathGlobFilter", opts.glob).option("recursiveFileLookup", opts.recursive)
              .csv(list(files)).where(name_filter))
    else:
        df = reader.csv([reader_path(p) for p in files])
    df = (with_file_order(df).withColumn(SOURCE, file_name())
          .withColumn(PATH, F.col("_metadata.file_path")))
    # Empty prefixes of every data column keep them all in the scan's required schema:
    # Spark refuses a CSV scan returning only the corrupt-record column, and with
    # column pruning a row's cell count is only checked against the columns read.
    anchors = [F.substring(F.coalesce(F.col(f"`{h}`"), F.lit("")), 1, 0) for h in header]
    raw_line = F.concat(*anchors, F.col(CORRUPT))
    df = df.withColumn("_cells", F.when(F.col(CORRUPT).isNotNull(), cell_count(raw_line, opts.sep)))
    return _finish(df.drop(CORRUPT), header, opts)


def name_predicate(opts: CsvOptions):
    """The file-name rules as a predicate on the file name, an expression of
    ``_metadata.file_name`` only (Spark prunes the files it rejects while listing,
    before opening them)."""
    name = file_name()
    cond = F.lit(True)
    if opts.exclude:
        cond = cond & ~name.rlike("(?i)" + "|".join(f"(?:{p})" for p in opts.exclude))
    if opts.include:
        cond = cond & name.rlike("(?i)" + opts.include)
    return cond


def read_aligned(spark: SparkSession, root: str | Sequence[str], opts: CsvOptions = CsvOptions(),
                 bad_files: str = "keep", failed: str = "raise") -> tuple[DataFrame, list[str]]:
    """Discovery + reference header + positional read.  ``bad_files='drop'`` removes whole
    files holding a row longer than the header (the strict reading of such files).
    ``failed='skip'`` (``'skip_whole'``: after reading them to the end) leaves out the files
    of the failure ledger, the reference header included; the others are read.

    The scan reads the roots themselves (recursive, glob) with the name rules as a
    file-name predicate, so the files are listed once by the scan's own file index."""
    files = discover(spark, root, opts)
    ledger: dict[str, str] = {}
    if failed != "raise":
        files, ledger = split_failed(spark, files, opts, whole=failed == "skip_whole")
        if not files:
            raise NoSourceFiles(f"no source file under {root} can be read")
    header = reference_header(spark, files, opts)
    roots = [root] if isinstance(root, str) else list(root)
    if len(ledger) > MAX_PATH_PREDICATE:
        df = read_positional(spark, files, header, opts)
    else:
        wanted = name_predicate(opts)
        if ledger:
            wanted = wanted & ~F.col("_metadata.file_path").isin(sorted(ledger))
        df = read_positional(spark, roots, header, opts, name_filter=wanted)
    if bad_files == "drop":
        too_long = (df.where(F.col("_cells") > len(header)).select(F.col(PATH).alias("__bad")).distinct())
        # at most one row per file: broadcast under the driver's own file count, so a
        # hot file never meets a shuffle join
        too_long = per_file_broadcast(too_long, len(files))
        df = df.join(too_long, df[PATH] == too_long["__bad"], "left_anti")
    return df, header


def read_by_name(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions(),
                 roots: Sequence[str] | None = None) -> DataFrame:
    """Each file with its own (trimmed) header, missing columns NULL.  Up to ``MAX_HEADER_SCANS``
    distinct headers are scanned one by one and unioned by name, which prunes columns; more
    are one scan by position, whose cells every file puts in their places.

    With ``roots``, a scan of up to ``MAX_PATH_PREDICATE`` files lists the roots (glob,
    recursive) and keeps its files by a ``_metadata.file_path`` membership predicate,
    pruned while listing.  A larger group, or no ``roots``, hands its paths to the file
    index instead (a parallel listing job for long lists): the plan, shipped with every
    task, then carries no list of paths."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, line in collect_header_lines(spark, files, opts):   # one short row per file
        by_header.setdefault(tuple(split_header(line, opts)), []).append(path)
    if not by_header:
        raise NoSourceFiles("every source file is empty")
    if len(by_header) > MAX_HEADER_SCANS:
        return _read_by_places(spark, by_header, opts, roots)
    out = None
    for names, paths in sorted(by_header.items(), key=lambda kv: min(kv[1])):
        reader = opts.reader(spark).schema(_string_schema(names)).option("header", True)
        if roots and len(paths) <= MAX_PATH_PREDICATE:
            part = (reader.option("pathGlobFilter", opts.glob).option("recursiveFileLookup", opts.recursive)
                    .csv(list(roots)).where(F.col("_metadata.file_path").isin(sorted(paths))))
        else:
            part = reader.csv([reader_path(p) for p in sorted(paths)])
        part = (with_file_order(part).withColumn(SOURCE, file_name())
                .withColumn(PATH, F.col("_metadata.file_path")).drop(CORRUPT))
        part = _finish(part, names, opts)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _read_by_places(spark: SparkSession, by_header: dict[tuple[str, ...], list[str]], opts: CsvOptions,
                    roots: Sequence[str] | None) -> DataFrame:
    """One scan for files of any headers: cells by position, then one permutation per file (a
    short row each, broadcast under the driver's own file count)."""
    ordered = sorted(by_header.items(), key=lambda kv: min(kv[1]))
    header: dict[str, str] = {}   # names are one column whatever their case, as in a union
    for names, _ in ordered:
        for n in names:
            header.setdefault(n.lower(), n)
    rows = []
    for names, paths in ordered:
        at = {n.lower(): i for i, n in enumerate(names)}
        places = [at.get(n, -1) for n in header]
        rows += [(p, places) for p in paths]
    width = max(len(names) for names, _ in ordered)
    reader = opts.reader(spark).schema(_string_schema([f"c{i}" for i in range(width)])).option("header", True)
    if roots and len(rows) <= MAX_PATH_PREDICATE:
        df = (reader.option("pathGlobFilter", opts.glob).option("recursiveFileLookup", opts.recursive)
              .csv(list(roots)).where(F.col("_metadata.file_path").isin(sorted(p for p, _ in rows))))
    else:
        df = reader.csv([reader_path(p) for p, _ in rows])
    df = (with_file_order(df).withColumn(SOURCE, file_name())
          .withColumn(PATH, F.col("_metadata.file_path")).drop(CORRUPT))
    places = per_file_broadcast(spark.createDataFrame(rows, "__p string, __places array<int>"), len(rows))
    cells = F.array(*[F.col(f"c{i}") for i in range(width)])
    df = df.withColumn("__cells", cells).join(places, F.col(PATH) == F.col("__p"))
    cols = []
    for j, n in enumerate(header.values()):
        cell = F.get(F.col("__cells"), F.get("__places", j))
        if opts.repair_values:
            cell = repair_mojibake(cell)
        cell = na_to_null(cell) if opts.na_tokens else F.coalesce(cell, F.lit(""))
        # a column the file does not have stays NULL, whatever an empty cell is
        cols.append(F.when(F.get("__places", j) >= 0, cell).alias(n))
    return df.select(*cols, ORDER_COL, SOURCE, PATH)


def _without_first_lines(batches):
    """Rows (path, block, pos, value) in file order, without the first row of each file."""
    import numpy as np
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks = batch.column(0), batch.column(1).to_numpy()
        code = paths.dictionary_encode().indices.to_numpy()
        begins = np.r_[True, (code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])]
        begins[0] = last != (paths[0].as_py(), blocks[0])
        last = (paths[-1].as_py(), blocks[-1])
        yield batch.filter(_arrow_mask(~(begins & (blocks == 0))))


def _arrow_mask(mask):
    import pyarrow as pa
    return pa.array(mask)


def read_raw_lines(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions()) -> DataFrame:
    """Data lines as text (first line of each file dropped, blank lines kept), for row-level
    validation.  One scan: a file block is read by one task from its start, so the task that
    reads a file's first block drops its first row.  The text source takes bytes as UTF-8;
    other encodings are decoded from the bytes."""
    value = F.col("value")
    if opts.encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), opts.encoding)
    df = (spark.read.text([reader_path(p) for p in files])
          .select(F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias("block"),
                  F.monotonically_increasing_id().alias("pos"), value.alias("value"))
          .mapInArrow(_without_first_lines, f"{PATH} string, block long, pos long, value string"))
    order = F.struct(path_key(F.col(PATH)).alias("path"), "block", "pos")
    return df.select("value", order.alias(ORDER_COL), unescape(F.element_at(F.split(PATH, "/"), -1)).alias(SOURCE), PATH)


def cell_places(spark: SparkSession, files: Sequence[str], opts: CsvOptions = CsvOptions()
                ) -> tuple[list[str], DataFrame]:
    """The common header of files whose columns differ in order or number (the names of the
    first file, then what later files add), and per file the place of each of its columns in
    the file's own rows, -1 where it has none.  One short row per file, marked for broadcast
    under the driver's own file count."""
    lines = sorted(collect_header_lines(spark, files, opts), key=lambda x: path_sort_key(x[0]))
    own = [(path, split_header(line, opts)) for path, line in lines]
    header = list(dict.fromkeys(n for _, names in own for n in names))
    rows = [(path, [names.index(n) if n in names else -1 for n in header]) for path, names in own]
    places = spark.createDataFrame(rows, "__p string, __places array<int>")
    return header, per_file_broadcast(places, len(files))
