"""Spelling variants by blocked Gram matrices of letter counts.

Words are the runs of ``LETTERS`` in the whole texts, A-Z lower-cased, thinned by a fixed rule
(below), of ``MIN_LENGTH`` code points or more that occur ``MIN_COUNT`` times or more.  Two
words are near when one inserted, deleted or replaced code point makes one the other.

1. **Vocabulary.**  Runs are counted with map-side sums; only distinct words travel.
2. **Blocks.**  Letters fall into a few classes of about equal use.  Words of one length
   with the same number of letters of every class are a block.  One edit adds a letter to a
   class (the adjacent length) or moves one from a class to another, so the words near a
   block's words lie in the block itself and in few others, known from its key alone.  The
   number of classes follows the number of words.  A block is dealt to tiles of about
   ``TILE`` words by the words' hash, so that none grows with a frequent pattern.
3. **Gram matrices.**  A pair of tiles is one row and one matrix product of letter-count
   vectors, in NumPy: it gives all squared distances of the pair.  An insertion changes the
   distance from 0 to 1, a replacement to 2, so pairs of at most two pass, and their edits
   are verified letter by letter.  A pair of tiles returns, per word, the number of near
   words and the best of them; pairs of words are never written.
4. **Forms and roots.**  Sums and minima per word give its form: the near word of largest
   count (ties: smallest in code-point order) if that is at least twice the word's own.
   Following forms at least doubles the count with each step, so doubling the pointers ends
   after a few rounds.

The thinning rule: with h the unsigned CRC-32 of ``<id>:<lower-cased run>``, a run whose h
is a multiple of ``THIN`` loses its code point h % length.

NULL and empty texts have no words, a NULL id reads as empty in the rule, rows that repeat an
id count again, an empty table gives no rows, and other columns are ignored.  A word may be
of any length.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import ascii_lower, cut, written
from alertfold.operators.small import bounded_broadcast

LETTERS = "[A-Za-zÀ-ÿ]+"
THIN = 97
MIN_LENGTH = 5
MIN_COUNT = 3
TILE = 1024
TILE_BYTES = 1 << 20
BLOCK_WORDS = 300        # words of a block that the number of classes aims at
MAX_CLASSES = 10
TASK_PAIRS = 40_000_000   # pairs of words whose distances a task computes, about
VERIFY = 200_000          # pairs verified at once
DIMS = 32


def thinned(doc_id: Column, run: Column) -> Column:
    """The run after the thinning rule."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % THIN == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
                  ).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``."""
    runs = docs.select(F.col(id_col).alias("doc_id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    lowered = runs.select("doc_id", ascii_lower(F.col("run")).alias("run"))
    words = lowered.select(thinned(F.col("doc_id"), F.col("run")).alias("word")).filter(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _matrix(words: bytes, count: int) -> np.ndarray:
    """Equally long words, one after the other, as a matrix of code points (all below 256)."""
    return np.frombuffer(words, np.uint8).reshape(count, -1)


#: Buckets of the letter-count vectors: a to z have their own, the others share; letters that
#: share a bucket only bring words closer, so no near pair is lost.
_BUCKET = np.array([c - 97 if 97 <= c <= 122 else 26 + c % (DIMS - 26) for c in range(256)])


def letter_counts(codes: np.ndarray, of: np.ndarray, dims: int, kind=np.int64) -> np.ndarray:
    """Per row of ``codes`` how many of its letters fall into each of ``of``'s ``dims`` values."""
    rows, length = codes.shape
    flat = np.repeat(np.arange(rows), length) * dims + of[codes.reshape(-1)]
    return np.bincount(flat, minlength=rows * dims).reshape(rows, dims).astype(kind)


def n_classes(words: int) -> int:
    """The smallest number of letter classes that leaves about ``BLOCK_WORDS`` words a block,
    for six usual lengths of about eight letters."""
    return next((k for k in range(1, MAX_CLASSES) if words <= BLOCK_WORDS * 6 * comb(7 + k, k - 1)), MAX_CLASSES)


def letter_classes(use: dict[int, int], classes: int) -> np.ndarray:
    """The class of each code point below 256: the most used letter first, each to the class
    used least so far."""
    of, load = np.zeros(256, np.int64), [0] * classes
    for c in sorted(range(256), key=lambda c: (-use.get(c, 0), c)):
        k = min(range(classes), key=lambda k: (load[k], k))
        of[c] = k
        load[k] += use.get(c, 0)
    return of


def _use(batches):
    total = np.zeros(256, np.int64)
    for batch in batches:
        for w in batch.column(0).to_pylist():
            total += np.bincount(np.frombuffer(w.encode("latin-1"), np.uint8), minlength=256)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["c", "n"])


def block_keys(words: list[str], of: np.ndarray, classes: int) -> list[str]:
    """The number of letters of each class, comma-joined."""
    out: list[str] = [""] * len(words)
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for at in by_length.values():
        codes = _matrix("".join(words[i] for i in at).encode("latin-1"), len(at))
        for i, row in zip(at, letter_counts(codes, of, classes).tolist()):
            out[i] = ",".join(map(str, row))
    return out


def later_blocks(key: str) -> list[str]:
    """The blocks to compare a block with so that each pair of blocks comes once: itself, one
    letter more in a class, one letter moved to an earlier class."""
    counts = list(map(int, key.split(",")))
    out = [key]
    for i in range(len(counts)):
        more = counts.copy()
        more[i] += 1
        out.append(",".join(map(str, more)))
        for j in range(i + 1, len(counts)):
            if counts[j]:
                moved = more.copy()
                moved[j] -= 1
                out.append(",".join(map(str, moved)))
    return out


def _keyed(of: np.ndarray, classes: int):
    def run(batches):
        for batch in batches:
            keys = block_keys(batch.column(0).to_pylist(), of, classes)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *batch.columns], names=["block", "word", "n"])
    return run


def _compared(batches):
    for batch in batches:
        keys = batch.column(0).to_pylist()
        pairs = [(k, other) for k in keys for other in later_blocks(k)]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.string()),
                                          pa.array([b for _, b in pairs], pa.string())], names=["block", "other"])


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of ``a`` become their row of ``b`` (as long, or one longer) by one edit."""
    length = a.shape[1]
    off = a != b[:, :length]
    if b.shape[1] == length:
        return off.sum(1) == 1
    back = a[:, ::-1] != b[:, :0:-1]
    front = np.where(off.any(1), off.argmax(1), length)
    rear = np.where(back.any(1), back.argmax(1), length)
    return front + rear >= length


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` that are near; for a tile with itself only i < j."""
    kind = np.float32 if a.shape[1] < 2000 else np.float64  # whole numbers stay exact
    x, y = (letter_counts(m, _BUCKET, DIMS, kind) for m in (a, b))
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero(distance <= 2)
    if same:
        i, j = i[i < j], j[i < j]
    step = max(1, VERIFY * 8 // max(8, a.shape[1]))
    good = [np.zeros(0, bool)] + [_one_edit(a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
    good = np.concatenate(good)
    return i[good], j[good]


def _best(own: np.ndarray, other: np.ndarray, n_other: np.ndarray):
    """Per word its number of near words, and the place of that of largest count, the first of
    equals (a tile's words are in code-point order)."""
    order = np.lexsort((other, -n_other[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    return own[first], np.diff(np.r_[first, len(own)]), other[first]


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
_NEAR_DDL = "word string, n_near long, best_n long, best string"


def _near(batches):
    """Pairs of tiles -> what each word learns from the pair."""
    for batch in batches:
        for a, n_a, b, n_b, same in zip(*(batch.column(c) for c in ("a", "n_a", "b", "n_b", "same"))):
            n = [x.values.to_numpy() for x in (n_a, n_b)]
            codes = [_matrix(x.as_buffer(), len(k)) for x, k in zip((a, b), n)]
            i, j = near_pairs(*codes, same.as_py())
            for own, other, x, y in ((i, j, 0, 1), (j, i, 1, 0)):
                if same.as_py():
                    own, other = np.r_[i, j], np.r_[j, i]
                word, many, best = _best(own, other, n[y])
                if len(word):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([codes[x][k].tobytes().decode("latin-1") for k in word], pa.string()),
                         pa.array(many, pa.int64()), pa.array(n[y][best], pa.int64()),
                         pa.array([codes[y][k].tobytes().decode("latin-1") for k in best], pa.string())], schema=_NEAR)
                if same.as_py():
                    break


def near_words(words: DataFrame, classes: int | None = None, tile: int = TILE) -> DataFrame:
    """``word, n_near, best, best_n`` for the words of ``word, n`` that have near ones."""
    spark = words.sparkSession
    count = words.count()
    use = {r.c: r.n for r in words.select("word").mapInArrow(_use, "c int, n long")
           .groupBy("c").agg(F.sum("n").alias("n")).collect()}  # a row a letter
    classes = classes or n_classes(count)
    of = letter_classes(use, classes)
    keyed = cut(words.select("word", "n").mapInArrow(_keyed(of, classes), "block string, word string, n long"))
    per_tile = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_BYTES) / F.any_value(F.length("word")))))
    blocks = bounded_broadcast(keyed.groupBy("block").agg(F.count("*").alias("size"),
                                                          F.ceil(F.count("*") / per_tile).cast("int").alias("tiles")))
    member = F.sort_array(F.collect_list(F.struct("word", "n")))
    tiles = cut(keyed.join(blocks, "block")
                .groupBy("block", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int").alias("tile"))
                .agg(member.alias("m"))
                .select("block", "tile", F.encode(F.array_join("m.word", ""), "ISO-8859-1").alias("words"),
                        F.col("m.n").alias("ns")))
    compared = blocks.select("block").mapInArrow(_compared, "block string, other string")
    left = tiles.select("block", F.col("tile").alias("tile_a"), F.col("words").alias("a"), F.col("ns").alias("n_a"))
    right = tiles.select(F.col("block").alias("other"), F.col("tile").alias("tile_b"), F.col("words").alias("b"),
                         F.col("ns").alias("n_b"))
    sizes = blocks.select("block", "size")
    pairs = cut(compared.join(sizes, "block").join(sizes.select(F.col("block").alias("other"), F.col("size").alias("with")),
                                                   "other"))
    work = pairs.agg(F.sum(F.col("size").cast("double") * F.col("with"))).first()[0] or 0
    tasks = int(min(100_000, max(spark.sparkContext.defaultParallelism, work // TASK_PAIRS)))
    met = (pairs.select("block", "other").join(left, "block").join(right, "other")
           .filter((F.col("block") != F.col("other")) | (F.col("tile_a") <= F.col("tile_b")))
           .withColumn("same", (F.col("block") == F.col("other")) & (F.col("tile_a") == F.col("tile_b")))
           .repartition(tasks, "block", "other", "tile_a", "tile_b"))
    found = met.select("a", "n_a", "b", "n_b", "same").mapInArrow(_near, _NEAR_DDL)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form`` rows without cycles: the end of each chain of forms."""
    ahead = written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = ahead.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = written(ahead.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ahead = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return ahead


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE,
             classes: int | None = None) -> DataFrame:
    """``word, n, n_near, form, form_n, root``, one row per word."""
    words = written(vocabulary(docs, id_col, text_col))
    near = near_words(words, classes, tile)
    has_form = F.col("best_n") >= 2 * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has_form, F.col("best")).alias("form"),
        F.when(has_form, F.col("best_n")).alias("form_n")))
    ends = roots(formed.filter("form IS NOT NULL"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
