"""SentencePiece (BPE, byte fallback) encoding by backtracking over longest matches.

A token sequence is what the merges produce exactly when every two neighbours are: the
merges of the two tokens' joined text give the same two tokens back.  So a text is encoded
greedily with the longest token at each position (one Aho-Corasick pass finds all tokens),
each choice is checked against its left neighbour by re-merging at their boundary (the
two tokens' last merges are taken back in turn, latest first, until a merge across the
boundary would have come earlier; cached per pair), and a choice that fails falls back to
the next shorter token, or drops the last token.  A bitfield of positions known to fail
keeps the search linear.

Texts are cut where no token can cross: before a run of spaces that follows another
character, and around characters that no token holds (these become byte tokens, or the
unknown token).  The pieces of text between the cuts repeat, so each is encoded once per
worker and kept in a cache of bounded size.

Runs of spaces are merged directly: their tokens all have the same score, and equal scores
let the order of positions decide, which neighbour checks do not see.

NULL and empty texts have no tokens.  Lone surrogates cannot occur in Spark's strings.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.arrow import slices

INFINITE = float("inf")
SPACE = "▁"  # how a space is written inside the vocabulary
CACHE_BYTES = 120_000_000  # of a worker's chunks, about
ENTRY_BYTES = 230          # of an entry beside its characters
ODD_ENTRIES = 50_000
PAIR_ENTRIES = 150_000

#: Texts on which the model must behave as this encoder assumes (no character is
#: normalised, spaces are kept, one space is put in front).
PROBES = ("", "a", " a  b ", "\tA\n", "ﬁ é é 　", "① x")


class PieceBpe:
    """Vocabulary, automaton and caches of one model."""

    def __init__(self, model_path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for probe in PROBES:
            want = (SPACE + probe if probe else "").replace(" ", SPACE)
            if model.normalize(probe) != want:
                raise ValueError("only models with the identity normaliser and a leading space are supported")
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.byte_of = {i: int(self.names[i][3:5], 16) for i in range(len(self.names)) if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.unknown = model.unk_id()
        special = {i for i in range(len(self.names))
                   if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or i in self.byte_of}
        self.controls = {i for i in special if model.is_control(i)}
        self.ids = {p: i for i, p in enumerate(self.names) if i not in special}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.plain = {p for p in self.ids if len(p) == 1}
        if any(SPACE in p.lstrip(SPACE) or not self.plain.issuperset(p) for p in self.ids):
            raise ValueError("a token of this model crosses a space or holds a character that is no token")
        self.text_of = [None if i in special else p.replace(SPACE, " ") for i, p in enumerate(self.names)]
        # others never come out of the merges
        self.usable = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.usable:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.prefixes: dict[str, str | None] = {}
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.splits: dict[str, tuple[int, str, str]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.older_pairs: dict[tuple[str, str], bool] = {}
        self.cut_at = re.compile("|".join((
            f"{SPACE}+[^{SPACE}\n]*", f"[^{SPACE}\n]+", "\n+")))

    def merge(self, text: str, until: int = 1) -> list[str]:
        """The merges themselves: join the neighbours whose joined text scores best, the
        leftmost of equals, until no joined text is a token or ``until`` parts are left."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: str) -> tuple[float, str, str]:
        """A token's score and the two parts its last merge joined; one character has none and
        was there before all merges."""
        known = self.splits.get(token)
        if known is None:
            parts = (self.score[token], *self.merge(token, 2)) if len(token) > 1 else (INFINITE, token, "")
            known = self.splits[token] = parts
        return known

    def boundary_holds(self, left: str, right: str) -> bool:
        """Whether no merge across the boundary of two tokens comes before their own merges.
        Merges come by falling score and, of equal ones, from the left; so the later of the
        two tokens' last merges is taken back first, and what is left meets again."""
        before, strict = -INFINITE, True  # the merge taken back last: one across has to come before it
        while True:
            across = self.score.get(left + right)
            if across is not None and (across > before or not strict and across == before):
                return False
            (score_l, _, inner_l), (score_r, inner_r, _) = self.split(left), self.split(right)
            if score_l == score_r == INFINITE:
                return True
            if score_l < score_r:
                before, strict, left = score_l, True, inner_l
            else:
                before, strict, right = score_r, False, inner_r

    def agree(self, left: str, right: str) -> bool:
        """Whether two tokens can stand side by side: re-merging their text keeps them."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.older_pairs.get(key)
            if known is None:
                known = self.boundary_holds(left, right)
            if len(self.pairs) >= PAIR_ENTRIES // 2:
                self.older_pairs, self.pairs = self.pairs, {}
            self.pairs[key] = known
        return known

    def shorter(self, token: str) -> str | None:
        """The longest token that a token starts with, itself left out."""
        known = self.prefixes.get(token, "")
        if known == "":
            known = next((token[:k] for k in range(len(token) - 1, 0, -1) if token[:k] in self.usable), None)
            self.prefixes[token] = known
        return known

    def backtrack(self, text: str) -> list[str]:
        """The tokens of a text all of whose characters are tokens."""
        if text in self.usable:
            return [text]
        n = len(text)
        longest = [1] * n                 # size of the longest token from each position
        for end, size in self.automaton.iter(text):
            longest[end - size + 1] = size  # longer ones end later, so they come last
        failed = 0                        # bit i: no valid encoding goes on from i
        tokens: list[str] = []
        pos, last = 0, None
        token: str | None = text[:longest[0]]
        while True:
            while token is not None:
                end = pos + len(token)
                if not (failed and failed >> end & 1) and (last is None or self.agree(last, token)):
                    break
                token = self.shorter(token)
            if token is not None:
                tokens.append(token)
                if end == n:
                    return tokens
                pos, last = end, token
                token = text[pos:pos + longest[pos]]
            elif tokens:
                failed |= 1 << pos
                token = tokens.pop()
                pos -= len(token)
                token, last = self.shorter(token), tokens[-1] if tokens else None
            else:
                return self.merge(text)  # cannot happen with a consistent vocabulary

    def tokens(self, chunk: str) -> list[int]:
        """Ids of a stretch of text between two cuts."""
        if self.plain.issuperset(chunk):
            return self.run_ids(chunk)
        ids: list[int] = []
        run = ""
        for c in chunk:
            if c in self.plain:
                run += c
            else:
                ids += self.run_ids(run)
                run = ""
                ids += [self.id_of_byte.get(b, self.unknown) for b in c.encode()]
        return ids + self.run_ids(run)

    def run_ids(self, run: str) -> list[int]:
        """Ids of a text all of whose characters are tokens."""
        if not run:
            return []
        if run.startswith(SPACE * 2):
            return [self.ids[p] for p in self.merge_run(run)]
        return [self.ids[p] for p in self.backtrack(run)]

    def merge_run(self, run: str) -> list[str]:
        """A run that starts with several spaces: see the module's note on equal scores."""
        if len(run) <= 64:
            return self.merge(run)
        return _merge_long(run, self.score)

    def chunks(self, text: str) -> list[str]:
        return self.cut_at.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for chunk in self.chunks(text) for i in self.tokens(chunk)]

    def decode_part(self, ids: list[int]) -> str:
        """Text of ids between two cuts; the leading space is still there."""
        out: list = [self.text_of[i] for i in ids]
        if None not in out:
            return "".join(out)
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            if i not in self.controls:
                out.append(" ⁇ " if i == self.unknown else self.names[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.decode_part(ids)
        return text[1:] if text.startswith(" ") else text


def _merge_long(text: str, score: dict[str, float]) -> list[str]:
    """``PieceBpe.merge`` with a heap and linked neighbours, for long texts."""
    import heapq
    part: list[str | None] = list(text)
    left, right = list(range(-1, len(part) - 1)), list(range(1, len(part) + 1))
    heap = [(-score[text[i:i + 2]], i, text[i], text[i + 1])
            for i in range(len(part) - 1) if text[i:i + 2] in score]
    heapq.heapify(heap)

    def offer(i: int, j: int) -> None:
        s = score.get(part[i] + part[j])
        if s is not None:
            heapq.heappush(heap, (-s, i, part[i], part[j]))

    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = right[i]
        if part[i] != a or j >= len(part) or part[j] != b:
            continue  # one of the two has been merged meanwhile
        part[i], part[j] = a + b, None
        right[i] = right[j]
        if right[j] < len(part):
            left[right[j]] = i
            offer(i, right[j])
        if left[i] >= 0:
            offer(left[i], i)
    return [p for p in part if p is not None]


class _Cache(dict):
    """Chunk -> ids joined by commas; the few chunks whose ids decode to another text than
    their own have it in ``decodes``.  Bounded in bytes: when it is full, the entries become
    the older half, from which those still in use come back."""

    def __init__(self, bpe: PieceBpe):
        self.bpe = bpe
        self.used = 0
        self.older: dict[str, str] = {}
        self.decodes: dict[str, str] = {}

    def __missing__(self, chunk: str) -> str:
        got = self.older.get(chunk)
        if got is None:
            size = len(chunk)
            if 2 < size <= 64 and chunk[-2:] not in self.bpe.inside:
                # no token holds the last two characters together, so none crosses there; the
                # parts are looked up again each time, which leaves the room to words
                head, tail = chunk[:-1], chunk[-1]
                got = f"{self[head]},{self[tail]}"
                if self.decodes and (head in self.decodes or tail in self.decodes):
                    self.decodes[chunk] = self.decoded(head) + self.decoded(tail)
                return got
            ids = self.bpe.tokens(chunk)
            got = ",".join(map(str, ids))
            decoded = self.bpe.decode_part(ids)
            if decoded != chunk.replace(SPACE, " "):
                self.decodes[chunk] = decoded
        if len(chunk) <= 64:
            self.used += ENTRY_BYTES + len(chunk) + len(got)
            if self.used >= CACHE_BYTES // 2:
                self.older = dict(self)
                self.clear()
                self.used = 0
            self[chunk] = got
        return got

    def decoded(self, chunk: str) -> str:
        return self.decodes.get(chunk) or chunk.replace(SPACE, " ")

    def forget(self) -> None:
        """Between texts: what was decoded otherwise goes with all other entries."""
        if len(self.decodes) > ODD_ENTRIES:
            self.decodes.clear()
            self.older.clear()
            self.clear()
            self.used = 0


_loaded: dict[str, _Cache] = {}


def _cache(model_path: str) -> _Cache:
    if model_path not in _loaded:
        _loaded[model_path] = _Cache(PieceBpe(model_path))
    return _loaded[model_path]


def encode_text(cache: _Cache, text: str) -> tuple[str, str]:
    """Ids joined by commas, and the text decoded from them."""
    cache.forget()
    chunks = cache.bpe.chunks(text)
    ids = ",".join(map(cache.__getitem__, chunks))
    if cache.decodes and not cache.decodes.keys().isdisjoint(chunks):
        decoded = "".join(map(cache.decoded, chunks))
    else:
        decoded = "".join(chunks).replace(SPACE, " ")
    return ids, decoded[1:] if decoded.startswith(" ") else decoded


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """Encode every text and decode the ids again.

    ``doc_id, n_tokens, ids, decoded``; with ``digests`` the last two are replaced by the
    SHA-256 of the ids joined by commas and of the decoded text (``ids_sha256``,
    ``decoded_sha256``).
    """
    def run(batches):
        cache = _cache(model_path)
        for batch in batches:
            for part in slices(batch, 1):
                n, ids, decoded = [], [], []
                for text in part.column(1):
                    a, b = encode_text(cache, text.as_py() or "")
                    n.append(a.count(",") + 1 if a else 0)
                    ids.append(hashlib.sha256(a.encode()).hexdigest() if digests
                               else np.fromstring(a, np.int32, sep=",") if a else np.empty(0, np.int32))
                    decoded.append(hashlib.sha256(b.encode()).hexdigest() if digests else b)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()),
                     pa.array(ids, pa.string() if digests else pa.list_(pa.int32())), pa.array(decoded, pa.string())],
                    names=names)

    names = ["doc_id", "n_tokens"] + (["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    kinds = (id_type, "bigint", *(("string", "string") if digests else ("array<int>", "string")))
    return source.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
