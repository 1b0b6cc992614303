"""SentencePiece encoding and decoding: vectorised merge rounds.

Covers BPE models with an identity normaliser, a dummy prefix and byte fallback.
A text is cut where no piece can reach across (before a run of word marks, and
around line breaks), and each distinct word of a chunk of texts is encoded once.
A worker remembers the words of its latest chunks in two generations of bounded
size: a word that comes again moves to the newer one, the rest goes with the older.

All words' symbols lie in one flat numpy array. In each round every word finds
the best rank among its adjacent pairs (a segmented minimum), merges it at the
leftmost places, and the arrays are compacted; words without a pair left drop
out. Merging all places of the best rank at once equals the library's one at a
time unless a merge makes a pair of the same or a better rank: such a word
merges only its leftmost place in that round. A word of more than ``LONG_WORD``
symbols in which that happens is finished by a priority queue with the same
order, so that runs of white space don't take one round each.

Defined results: a null text is empty and has no ids; an empty table gives an
empty result; rows are encoded one by one, so repeated rows and other columns
don't matter.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cellar.llm._common import bound_batches, prepare, text_of, tidied

MARK = "▁"
NO_PAIR = np.iinfo(np.int64).max
LONG_WORD = 4096
#: Words whose encoding a worker remembers, in each of two generations (and those of the chunk at hand).
CACHE_WORDS = 150_000
#: Characters worked on at a time (a longer text alone).
BATCH_CHARS = 500_000
#: Characters of new words that are merged at a time (a longer word alone).
MERGE_CHARS = 200_000


class PairTable:
    """Pairs of symbols that merge: rank and merged symbol by (left, right), in an open-addressed table."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._ranks = np.full(1 << bits, -1, dtype=np.int32)
        self._made = np.full(1 << bits, -1, dtype=np.int32)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        ranks = np.array([v[0] for v in pairs.values()], dtype=np.int32)
        made = np.array([v[1] for v in pairs.values()], dtype=np.int32)
        place, todo = self._place(keys), np.arange(len(keys))
        while len(todo):  # each free place takes one of the keys that want it; the others go to the next place
            free = todo[self._keys[place[todo]] == -1]
            _, first = np.unique(place[free], return_index=True)
            won = free[first]
            self._keys[place[won]], self._ranks[place[won]], self._made[place[won]] = keys[won], ranks[won], made[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            place[todo] = (place[todo] + 1) & self._mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged symbol) of each key; NO_PAIR and -1 where the pair doesn't merge."""
        place = self._place(keys)
        found = self._keys[place]
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & self._mask
            found = self._keys[place[open_]]
            open_ = open_[(found != keys[open_]) & (found != -1)]
        hit = self._keys[place] == keys
        return (np.where(hit, self._ranks[place].astype(np.int64), NO_PAIR),
                np.where(hit, self._made[place].astype(np.int64), -1))

    def pairs(self) -> dict[int, tuple[int, int]]:
        """The pairs as they were given."""
        at = np.flatnonzero(self._keys != -1)
        return dict(zip(self._keys[at].tolist(), zip(self._ranks[at].tolist(), self._made[at].tolist())))


class PieceModel:
    """Vocabulary and merge table of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        symbols = {self.pieces[i]: i for i in plain}
        for ch in sorted({ch for i in plain for ch in self.pieces[i]} - symbols.keys()):
            symbols[ch] = n + len(symbols)  # a character that is only part of pieces
        self.base = n + len(symbols) + 1
        self.text = {i: s for s, i in symbols.items()}
        order = {s: r for r, s in enumerate(sorted({-sp.get_score(i) for i in plain}))}
        pairs = {}
        for i in plain:
            piece = self.pieces[i]
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = (order[-sp.get_score(i)], i)
        self.pairs = PairTable(pairs)
        if any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in symbols):
            raise ValueError("a piece reaches over a word boundary")
        self.chars = np.full(0x110000, -1, dtype=np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.chars[ord(s)] = i
        self.vocabulary = n
        self.names = [str(i) for i in range(n)]
        self.shown = [p.replace(MARK, " ") for p in self.pieces]
        self.is_byte = np.isin(np.arange(n), list(self.byte_of))

    @functools.cached_property
    def _pair(self) -> dict[int, tuple[int, int]]:
        """The merge table as a dict, for the queue of long words; few workers meet one."""
        return self.pairs.pairs()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = self.pairs.find(np.where((left >= 0) & (right >= 0), left * self.base + right, -2))
        return rank, made

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All symbols that the words end as, in one array, and how many each word has.

        A character outside the vocabulary is -(code point + 1).
        """
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        sym = np.where(self.chars[points] >= 0, self.chars[points], -points - 1)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        done_sym, done_word = [sym[:0]], [word[:0]]

        def pairs_at(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            nxt = np.minimum(at + 1, len(sym) - 1)
            rank, made = self._ranks(sym[at], sym[nxt])
            ok = (nxt > at) & (word[at] == word[nxt])
            return np.where(ok, rank, NO_PAIR), made

        rank, made = pairs_at(np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            ended = least == NO_PAIR
            if ended.any():  # compaction: finished words leave
                stay = np.repeat(~ended, sizes)
                done_sym.append(sym[~stay])
                done_word.append(word[~stay])
                sym, word, rank, made = sym[stay], word[stay], rank[stay], made[stay]
                continue
            per = np.repeat(least, sizes)
            want = rank == per
            idx = np.arange(len(sym))
            fresh = want & ~np.concatenate(([False], want[:-1]))
            run = np.maximum.accumulate(np.where(fresh, idx, 0))
            take = want & ((idx - run) % 2 == 0)  # overlapping places: every other one, from the left
            at = np.flatnonzero(take)
            # a merge is safe if the pairs it makes rank behind it, with the symbols before and after other merges
            after = np.minimum(at + 2, len(sym) - 1)
            in_word = (at + 2 < len(sym)) & (word[after] == word[at])
            r1 = np.where(in_word, self._ranks(made[at], sym[after])[0], NO_PAIR)
            before = np.maximum(at - 1, 0)
            prior = np.maximum(at - 2, 0)
            merged_before = (at >= 2) & take[prior]
            left = np.where(merged_before, made[prior], sym[before])
            has_left = (at >= 1) & (word[before] == word[at])
            r2 = np.where(has_left, self._ranks(left, made[at])[0], NO_PAIR)
            unsafe = np.unique(word[at[(r1 <= per[at]) | (r2 <= per[at])]])
            if len(unsafe):
                risky = np.isin(word, unsafe)
                first = take & (np.concatenate(([0], np.cumsum(take)[:-1])) == np.repeat(
                    np.concatenate(([0], np.cumsum(take)))[starts], sizes))
                take = np.where(risky, first, take)
                long_ = [w for w in unsafe if sizes[np.searchsorted(word[starts], w)] > LONG_WORD]
                if long_:
                    gone = np.zeros(len(sym), dtype=bool)
                    for w in long_:
                        s = starts[np.searchsorted(word[starts], w)]
                        n = sizes[np.searchsorted(word[starts], w)]
                        done_sym.append(self._queue_merge(sym[s:s + n]))
                        done_word.append(np.full(len(done_sym[-1]), w))
                        gone[s:s + n] = True
                    sym, word, rank, made, take = sym[~gone], word[~gone], rank[~gone], made[~gone], take[~gone]
                at = np.flatnonzero(take)
            sym = sym.copy()
            sym[at] = made[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            if not len(sym):
                break
            touched = np.unique(np.concatenate((moved[at], np.maximum(moved[at] - 1, 0))))
            if len(touched):
                rank[touched], made[touched] = pairs_at(touched)
        order = np.concatenate(done_word)
        return (np.concatenate(done_sym)[np.argsort(order, kind="stable")],
                np.bincount(order, minlength=len(words)))

    def _queue_merge(self, symbols: np.ndarray) -> np.ndarray:
        """One word by a priority queue of (rank, place): the order of one merge at a time."""
        sym = symbols.tolist()
        prev, nxt = list(range(-1, len(sym) - 1)), list(range(1, len(sym) + 1))
        nxt[-1] = -1
        queue: list[tuple[int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and sym[i] >= 0 and sym[j] >= 0:
                hit = self._pair.get(sym[i] * self.base + sym[j])
                if hit:
                    heapq.heappush(queue, (hit[0], i, sym[i], sym[j]))

        alive = [True] * len(sym)
        for i in range(len(sym) - 1):
            push(i, i + 1)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = nxt[i] if alive[i] else -1
            if j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i] = self._pair[a * self.base + b][1]
            alive[j] = False
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prev[nxt[i]] = i
            push(prev[i], i)
            push(i, nxt[i])
        return np.array([s for s, live in zip(sym, alive) if live], dtype=np.int64)

    def ids(self, symbols: list[int]) -> list[int]:
        """Token ids of symbols; what isn't in the vocabulary goes byte by byte."""
        out: list[int] = []
        for s in symbols:
            if 0 <= s < self.vocabulary:
                out.append(s)
            else:
                ch = self.text[s] if s >= 0 else chr(-s - 1)
                out.extend(self.bytes[b] for b in ch.encode("utf-8", "surrogatepass"))
        return out

    def encode_words(self, words: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by commas, raw decoded text) of each word."""
        symbols, counts = self.merge(words)
        odd = (symbols < 0) | (symbols >= self.vocabulary) | self.is_byte[np.clip(symbols, 0, self.vocabulary - 1)]
        ends = np.cumsum(counts)
        odd_before = np.concatenate(([0], np.cumsum(odd)))
        plain = (odd_before[ends] == odd_before[ends - counts]).tolist()
        flat = symbols.tolist()
        names = [self.names[i] if 0 <= i < self.vocabulary else "" for i in flat] if odd.any() else [
            self.names[i] for i in flat]
        texts = [self.shown[i] if 0 <= i < self.vocabulary else "" for i in flat] if odd.any() else [
            self.shown[i] for i in flat]
        a = 0
        for b, ok in zip(ends.tolist(), plain):
            if ok:
                yield b - a, ",".join(names[a:b]), "".join(texts[a:b])
            else:
                ids = self.ids(flat[a:b])
                yield len(ids), ",".join([self.names[i] for i in ids]), self.decode_raw(ids)
            a = b

    def decode_raw(self, ids: list[int]) -> str:
        """The text of ids, word marks as blanks, the dummy prefix still there."""
        parts, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                parts.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            parts.append(self.pieces[i])
        if pending:
            parts.append(pending.decode("utf-8", "replace"))
        return "".join(parts).replace(MARK, " ")

    def words(self, text: str) -> list[str]:
        """A text cut where no merge reaches across, dummy prefix included; an empty text has no words."""
        return _WORDS.findall(MARK + text.replace(" ", MARK)) if text else []


_WORDS = re.compile(f"{MARK}+[^{MARK}\n]*|\n|[^{MARK}\n]+")


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    return PieceModel(path)


class Codec:
    """Encodes and decodes texts with a bounded memory of words."""

    def __init__(self, path: str):
        self.model = load_model(path)
        #: Ids of words, joined by commas: the newer and the older generation.
        self._known: dict[str, str] = {}
        self._older: dict[str, str] = {}
        #: Decoded texts that aren't the word itself with blanks for its marks.
        self._shown: dict[str, str] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self._known) + len(words - self._known.keys()) > CACHE_WORDS:
            self._known, self._older = {}, self._known
            self._shown = {w: t for w, t in self._shown.items() if w in self._older}
        fresh = words - self._known.keys()
        back = fresh & self._older.keys()
        self._known.update((w, self._older[w]) for w in back)
        new = list(fresh - back)
        for part in chunks_of(new, MERGE_CHARS):
            for w, (_, ids, shown) in zip(new[part], self.model.encode_words(new[part])):
                self._known[w] = ids
                if shown != w.replace(MARK, " "):
                    self._shown[w] = shown

    def rows(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids joined by commas, decoded text) of each text."""
        cut = [self.model.words(t) for t in texts]
        self._learn(set().union(*cut))
        known, odd = self._known, self._shown
        for words in cut:
            if not words:
                yield 0, "", ""
                continue
            ids = ",".join([known[w] for w in words])
            shown = "".join([odd.get(w, w) for w in words] if odd else words)
            yield ids.count(",") + 1, ids, shown.replace(MARK, " ")[1:]


def encode(texts: list[str], model_path: str) -> list[list[int]]:
    """Token ids of texts."""
    return [[int(i) for i in ids.split(",")] if ids else [] for _, ids, _ in Codec(model_path).rows(texts)]


def decode(ids: list[int], model_path: str) -> str:
    """The text of token ids."""
    raw = load_model(model_path).decode_raw(ids)
    return raw[1:] if raw.startswith(" ") else raw


def chunks_of(texts: list[str], most: int) -> Iterator[slice]:
    """Slices of ``texts`` of about ``most`` characters (at least one text each)."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield slice(begin, i)
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def _batch(rows: list[tuple[int, str, str]], doc_ids: pa.Array, keep_ids: bool, keep_text: bool) -> pa.RecordBatch:
    """What :func:`encoded` returns for some rows."""
    columns = {
        "doc_id": doc_ids,
        "n_tokens": pa.array([n for n, _, _ in rows], pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(ids.encode()).hexdigest() for _, ids, _ in rows], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(text.encode()).hexdigest() for _, _, text in rows], pa.string()),
    }
    if keep_ids:
        flat = np.array(",".join([ids for n, ids, _ in rows if n]).split(","), dtype=np.int32) if any(
            n for n, _, _ in rows) else np.zeros(0, dtype=np.int32)
        ends = np.cumsum([0, *[n for n, _, _ in rows]], dtype=np.int32)
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
    if keep_text:
        columns["decoded"] = pa.array([text for _, _, text in rows], pa.string())
    return pa.RecordBatch.from_pydict(columns)


def encoded(docs: DataFrame, model_path: str, keep_ids: bool = False, keep_text: bool | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ``keep_ids`` adds the ids (array) and, unless ``keep_text`` is false, the decoded text.
    """
    prepare(docs.sparkSession)
    bound_batches(docs.sparkSession)
    keep_text = keep_ids if keep_text is None else keep_text
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in chunks_of(texts, BATCH_CHARS):
                doc_ids = batch.column("doc_id")[part]
                yield _batch(list(codec.rows(texts[part])), doc_ids, keep_ids, keep_text)

    more = (", ids array<int>" if keep_ids else "") + (", decoded string" if keep_text else "")
    return rows.mapInArrow(tidied(run), f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
