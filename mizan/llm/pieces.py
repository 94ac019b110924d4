"""SentencePiece encoding and decoding for merge-type vocabularies.

Adjacent symbol pairs wait in an agenda ordered by piece score, then by place; the best is
merged until no pair makes a piece; the agendas of short parts are served in step.  No piece spans a change from other characters to the
space mark, or a line end (checked when the model is read), so a text falls into parts that
are encoded apart and remembered.  Each Arrow batch is checked against the sentencepiece
library, which encodes and decodes all its whole texts as well.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, carried, schema_with, table

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: What no piece spans: a text falls into these parts, in which spaces stand for space marks (a mark in a text is one, too).
PARTS = re.compile(" *[^ \n]+| +|\n")
#: Parts that an encoder remembers of late, and as many before; some 250 bytes each.
REMEMBERED = 500_000
#: Every character a text can have, for a look at the normaliser; those of surrogates and null are none.
ALPHABET = "".join(map(chr, (*range(1, 0xD800), *range(0xE000, 0x110000)))) + "  a "
#: Characters up to which agendas are rows that are merged in step, and the widths of their matrices; beyond, each is a heap.
SHORT, WIDTHS = 48, (4, 6, 8, 10, 12, 16, 24, 48)
#: Rows of a matrix; the rank of what is no piece; characters of a part that is remembered.
IN_STEP, NONE, LONGEST = 16_384, 1 << 30, 64
#: Bits of a pair's slot.
SLOT_BITS = 20
_SPREAD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - SLOT_BITS)


class Encoder:
    """A model's pieces; encode() and decode() give what the library's do, without begin and end ids."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib = self.library
        size = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        #: The better a piece's score, the smaller its cost.
        self.costs = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.values = {i: b for b, i in self.bytes.items()}
        self.control = {i for i in special if lib.is_control(i)}
        self.unknown, self.last_special = lib.unk_id(), max(special)
        #: Each id's decimal digits after a comma, filled up with null bytes.
        self.decimals = np.array([f",{i}" for i in range(size)], "S").view(np.uint8).reshape(size, -1)
        if lib.normalize(ALPHABET) != SPACE + ALPHABET.replace(" ", SPACE):
            raise ValueError("a model is needed whose normaliser only sets a space mark before a text and for each space")
        spanning = [p for p in self.ids if re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p and len(p) > 1]
        if spanning or len(self.bytes) != 256:
            raise ValueError("a merge vocabulary with byte fallback is needed, in which space marks only begin pieces and line ends stand alone")
        self.tables()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Parts that do not decode to themselves, and what they decode to.
        self.altered: dict[str, str] = {}

    def merge(self, part: str) -> list[int]:
        """Ids of one part: the agenda of adjacent pairs, best score first, then leftmost."""
        symbols = self.merged_long(part.replace(" ", SPACE))
        try:
            return list(map(self.ids.__getitem__, symbols))
        except KeyError:
            pass
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            out += [i] if i is not None else [self.bytes[b] for b in s.encode("utf-8", "surrogatepass")]
        return out

    def merged_all(self, parts: list[str]) -> tuple[list[tuple[str, bytes]], list[tuple[str, list[int]]]]:
        """Each part with its ids: parts whose ids are pieces that make up the part, with the bytes of 32-bit ids, and others.

        Parts of like length are merged in step: their agendas are the rows of a matrix, and in each step every row takes the
        best of its pairs, the leftmost of several."""
        if not parts:
            return [], []
        whole, others = [], []
        length = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(length)
        starts = ends - length
        symbols = self.of_char[np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)]
        strange = np.concatenate([[0], np.cumsum(symbols < 0)])
        fine = (strange[ends] == strange[starts]) & (length <= SHORT)
        others += [(parts[k], self.merge(parts[k])) for k in np.flatnonzero(~fine).tolist()]
        symbols = np.append(symbols, np.full(SHORT, -1, np.int32))
        for low, high in zip((0, *WIDTHS), WIDTHS):
            rows = np.flatnonzero(fine & (length > low) & (length <= high))
            for at in range(0, len(rows), IN_STEP):
                some = rows[at : at + IN_STEP]
                n = length[some]
                grid = symbols[starts[some][:, None] + np.arange(high)]
                grid[np.arange(high) >= n[:, None]] = -1
                n = self.merged_rows(grid, n)
                # A character that is no piece of its own and was in none falls to its bytes.
                odd = (grid >= len(self.pieces)).any(axis=1)
                others += [(parts[k], self.merge(parts[k])) for k in some[odd].tolist()]
                raw, width = grid.astype("<i4").tobytes(), 4 * high
                good = np.flatnonzero(~odd)
                whole += [(parts[k], raw[i : i + size]) for k, i, size in zip(some[good].tolist(), (good * width).tolist(), (4 * n[good]).tolist())]
        return whole, others

    def merged_rows(self, grid: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Merges the rows of symbols in place until no pair is left; returns their lengths."""
        out, todo, rows = n.copy(), np.arange(len(grid)), grid
        columns = np.arange(grid.shape[1])
        cost = self.ranks[self.pairs(rows[:, :-1], rows[:, 1:])]
        while True:
            at = cost.argmin(axis=1)
            going = cost[np.arange(len(at)), at] < NONE
            if not going.all():
                grid[todo[~going]] = rows[~going]
                todo, rows, cost, at = todo[going], rows[going], cost[going], at[going]
            if not len(todo):
                return out
            line = np.arange(len(todo))
            into = self.targets[self.pairs(rows[line, at], rows[line, at + 1])]
            # What stands behind the merged pair moves up by one.
            behind = columns > at[:, None]
            shifted = np.empty_like(rows)
            shifted[:, :-1], shifted[:, -1] = rows[:, 1:], -1
            rows = np.where(behind, shifted, rows)
            rows[line, at] = into
            moved = np.empty_like(cost)
            moved[:, :-1], moved[:, -1] = cost[:, 1:], NONE
            cost = np.where(behind[:, :-1], moved, cost)
            out[todo] -= 1
            # Only the pairs on either side of the new symbol are new.
            right = np.minimum(at, cost.shape[1] - 1)
            cost[line, right] = np.where(at == right, self.ranks[self.pairs(rows[line, right], rows[line, right + 1])], cost[line, right])
            left = np.maximum(at - 1, 0)
            cost[line, left] = self.ranks[self.pairs(rows[line, left], rows[line, left + 1])]

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair of symbols that is a piece, 0 for others; -1 is no symbol."""
        key = np.where((a < 0) | (b < 0), -2, a.astype(np.int64) * self.stride + b)
        found = self.slots[(key.view(np.uint64) * _SPREAD) >> _SHIFT]
        found[self.keys[found] != key] = 0
        if len(self.spilled):
            # The few pairs whose slot another pair has.
            again = self.spilled[np.minimum(np.searchsorted(self.spilled_keys, key), len(self.spilled) - 1)]
            found = np.where(self.keys[again] == key, again, found)
        return found

    def tables(self) -> None:
        """Symbols and the pairs of symbols that are pieces: every piece, cut in two in every way that leaves symbols."""
        lib_size = len(self.pieces)
        extra = sorted({c for p in self.ids for c in p}.difference(self.ids))
        number = self.ids | {c: lib_size + k for k, c in enumerate(extra)}
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in number.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.of_char[ord(" ")] = self.of_char[ord(SPACE)]
        self.stride = lib_size + len(extra) + 1
        order = {c: k for k, c in enumerate(sorted(set(self.costs.values())))}
        rows = [(number[p[:k]] * self.stride + number[p[k:]], order[self.costs[p]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in number and p[k:] in number]
        self.keys, self.ranks, self.targets = (np.array([none, *c], t) for none, c, t in zip((-1, NONE, 0), zip(*rows), (np.int64, np.int32, np.int32)))
        slot = (self.keys.view(np.uint64) * _SPREAD) >> _SHIFT
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        self.slots[slot[1:]] = np.arange(1, len(self.keys), dtype=np.int32)
        lost = 1 + np.flatnonzero(self.slots[slot[1:]] != np.arange(1, len(self.keys)))
        lost = lost[np.argsort(self.keys[lost])]
        self.spilled_keys, self.spilled = self.keys[lost], lost.astype(np.int32)

    def merged_long(self, part: str) -> list[str]:
        """The agenda as a heap; n log n for a part of n characters."""
        symbols, costs = list(part), self.costs
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            both = symbols[i] + symbols[j]
            if both in costs:
                heapq.heappush(agenda, (costs[both], i, j, both))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if symbols[i] is None or symbols[j] is None or after[i] != j or symbols[i] + symbols[j] != both:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s is not None]

    def text_of(self, ids) -> str:
        """The text of ids, space marks as spaces: runs of bytes decode together, and byte by byte where they are no UTF-8."""
        if ids and min(ids) > self.last_special:
            return "".join(map(self.pieces.__getitem__, ids)).replace(SPACE, " ")
        out, run = [], bytearray()
        for i in [*ids, -1]:
            if i in self.values:
                run.append(self.values[i])
                continue
            if run:
                out.append(replaced(bytes(run)))
                run.clear()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i >= 0 and i not in self.control:
                out.append(self.pieces[i])
        return "".join(out).replace(SPACE, " ")

    def remember(self, new: set[str]) -> list[str]:
        """Makes the ids of these parts known; returns those that are too long to stay so."""
        if len(self.known) + len(new) > self.remembered:
            self.known, self.older = {}, self.known
        before = self.older.keys() & new
        self.known.update(zip(before, map(self.older.__getitem__, before)))
        whole, others = self.merged_all(list(new - before if before else new))
        self.known.update(whole)
        for part, ids in others:
            self.known[part] = np.array(ids, "<i4").tobytes()
            if (text := self.text_of(ids)) != part:
                self.altered[part] = text
        return [part for part, _ in others if len(part) > LONGEST]

    def both_ways(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(bytes of 32-bit ids, the text they decode to) of each text."""
        collecting = gc.isenabled()
        gc.disable()  # nothing here refers to itself, and there is much that a collection would look at
        try:
            texts = [marked(t) for t in texts]
            parts = [PARTS.findall(" " + t) if t else [] for t in texts]
            ids = [list(map(self.known.get, own)) for own in parts]
            gaps = [places(None, own) for own in ids]
            passing = self.remember({own[i] for own, at in zip(parts, gaps) for i in at})
            known, altered, out = self.known, self.altered, []
            for text, own, got, at in zip(texts, parts, ids, gaps):
                for i in at:
                    got[i] = known[own[i]]
                if altered and not altered.keys().isdisjoint(own):
                    text = "".join([altered[p] if p in altered else p for p in own])[1:]
                out.append((b"".join(got), text))
            for part in passing:
                del known[part]
            return out
        finally:
            if collecting:
                gc.enable()

    def check(self, texts: list[str], ids: list[bytes], decoded: list[str]) -> None:
        """Holds the ids and the decoded text of whole texts against the library's."""
        numbers = self.library.encode(texts, num_threads=1, return_type="numpy")
        for text, own, back, n, library in zip(texts, ids, decoded, numbers, self.library.decode(numbers, num_threads=1)):
            if own != n.astype("<i4", copy=False).tobytes() or back != library:
                raise ValueError(f"the library encodes this text in another way: {text[:200]!r}")

    def encode(self, text: str | None) -> list[int]:
        parts = PARTS.findall(" " + marked(text)) if text else []
        return list(chain.from_iterable(map(self.merge, parts)))

    def decode(self, ids: list[int]) -> str:
        """Without the space that encoding sets before the text, if the first piece has it."""
        first = next((i for i in ids if i not in self.control), self.unknown)
        text = self.text_of(ids)
        return text[1:] if first not in self.values and self.pieces[first].startswith(SPACE) else text


def marked(text: str) -> str:
    """A text whose space marks are spaces; most have none, and stay as small in memory as they are."""
    return text.replace(SPACE, " ") if SPACE in text else text


def joined(decimals: np.ndarray, ids: np.ndarray) -> bytes:
    """Ids as decimals with commas between."""
    digits = decimals[ids].reshape(-1)
    return digits[digits != 0].tobytes()[1:]


def places(value, items: list) -> list[int]:
    """Where items has the value."""
    out, at = [], -1
    try:
        while True:
            at = items.index(value, at + 1)
            out.append(at)
    except ValueError:
        return out


def replaced(run: bytes) -> str:
    """UTF-8, each byte that fits nowhere as U+FFFD."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[i : i + n].decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    return Encoder(path, remembered)


def encoded(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False, remembered: int = REMEMBERED) -> DataFrame:
    """The ``keep`` columns, n_tokens, digests of ids and decoded text, and with ``with_ids`` the ids themselves.

    The library encodes and decodes the whole texts of each batch as well.  Where it differs the job fails: a digest
    that is not the library's is never returned.  ``remembered`` bounds a worker's memory, not the result.  A kept column named like a new one is an error.
    """
    made = ("n_tokens", "ids_sha256", "decoded_sha256", *(("ids",) if with_ids else ()))
    docs = carried(docs, keep, made, "text")

    def run(batch: pa.RecordBatch, e: Encoder) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n, ids_sha, text_sha, all_ids = [], [], [], []
        both = e.both_ways(texts)
        e.check(texts, [ids for ids, _ in both], [text for _, text in both])
        for ids, text in both:
            numbers = np.frombuffer(ids, "<i4")
            n.append(len(numbers))
            ids_sha.append(hashlib.sha256(joined(e.decimals, numbers)).hexdigest())
            text_sha.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            if with_ids:
                all_ids.append(numbers)
        new = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
        if with_ids:
            ends = np.cumsum([0, *map(len, all_ids)]).astype(np.int32)
            new["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(all_ids)))
        return pa.record_batch([batch.column("row"), *new.values()], names=["row", *new])

    schema = schema_with(docs, ("row",), "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    return arrow_map(docs, run, schema, lambda: encoder(path, remembered)).select("row.*", *made)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no ids and the digests of nothing; repeated rows and rows without doc_id stay; pairs
    with the same score merge from the left.
    """
    return encoded(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(MODEL))


QUERIES = {"op2_sentencepiece": op2_sentencepiece}
ORACLES: dict[str, str] = {}
