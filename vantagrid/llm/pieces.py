"""SentencePiece encoding and decoding with seeded merge-dropout.

A byte-pair vocabulary of pieces is read from its model file. A text is cut at blanks
and line ends, which no piece crosses, and each part is merged from characters by an
agenda: the best-scored pair first, leftmost among equals. With dropout each
candidate taken off the agenda is skipped where a keyed hash of seed, document, place of
the word in it, place in the word and piece falls below the rate, so every occurrence of
a word draws for itself and yet reruns agree. What is remembered of a word is a tree: a
node for each run of decisions that came again, with its pieces and the candidates that it
takes when nothing more is skipped. A word or a run of decisions that is met once so far is
merged by its own draws. Without dropout the result is that of the vocabulary's own encoder.

Decoding is lossless for every text: characters without a piece are spelled in byte
pieces, and so is the blank's own sign where a text holds it literally.

Null text encodes as empty; an empty text has no pieces. Texts of any length are
encoded whole; repeated rows repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from vantagrid.llm.common import bounded_batches, utf8

#: Where the vocabulary is unless told otherwise.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Sign of a blank in pieces.
BLANK = "▁"
#: Stands for the blank's sign where a text holds it; no word has a line end.
SIGN = "\n"
#: Rate of skipped merges, and nodes of words a task remembers.
DROPOUT, REMEMBERED = 0.1, 400_000

#: Rows of a block that are merged together, and words whose draws are looked at together.
ROWS, WORDS = 2048, 1 << 15
#: Characters of a part up to which its agenda is a list.
LONG = 48
#: Multiplier of a pair's bucket, and bits that buckets and slots leave out of 32.
BUCKET, BUCKET_BITS, SLOT_BITS = np.uint32(0x85EBCA6B), 18, 15
#: Rank of a pair that makes no piece.
NONE = 1 << 30


def _perfect(pairs: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A table in which every key has a slot for itself: a factor for each bucket of keys, and the slots' keys and values; keys that are not there, negative ones too, meet another or -1."""
    buckets: dict[int, list[int]] = {}
    for key in pairs:
        buckets.setdefault((key * int(BUCKET) & 0xFFFFFFFF) >> BUCKET_BITS, []).append(key)
    keys, values = np.full(1 << 32 - SLOT_BITS, -1, np.int32), np.full(1 << 32 - SLOT_BITS, NONE, np.int32)
    factors, taken = np.ones(1 << 32 - BUCKET_BITS, np.uint32), set()
    for bucket, some in sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0])):
        for factor in range(0x9E3779B1, 1 << 32, 2):
            slots = {(key * factor & 0xFFFFFFFF) >> SLOT_BITS for key in some}
            if len(slots) == len(some) and taken.isdisjoint(slots):
                break
        else:
            raise ValueError("too many pairs of pieces")
        taken |= slots
        factors[bucket] = factor
        for key in some:
            slot = (key * factor & 0xFFFFFFFF) >> SLOT_BITS
            keys[slot], values[slot] = key, pairs[key]
    return factors, keys, values


def _placed(out: list[np.ndarray], order: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists in one array, with the begin and size of each by its number; ``order`` has the numbers as the lists come."""
    numbers, n = np.concatenate(order), np.concatenate(counts)
    begin, size = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    begin[numbers], size[numbers] = np.cumsum(n) - n, n
    return np.concatenate(out), begin, size


class Grown:
    """An array that grows at its end."""

    def __init__(self, dtype: type):
        self.all, self.n = np.zeros(4096, dtype), 0

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.all):
            self.all = np.concatenate([self.all[: self.n], np.zeros(max(n, 2 * self.n) - self.n, self.all.dtype)])
        self.all[self.n : n] = values
        self.n = n


def skipped(key: int, place: int, rank: int, limit: int) -> bool:
    """Whether the candidate of this rank at this place is dropped: a keyed hash of 30 bits under the limit."""
    h = (key + place * 40503 + rank * 69621) & 0x3FFFFFFF
    h = (h ^ (h >> 15)) * 0x2C1B3C6D & 0x3FFFFFFF
    return (h ^ (h >> 13)) < limit


def dropped(mixed: np.ndarray, limit: int) -> np.ndarray:
    """``skipped`` of many candidates, their key, place and rank added up in 32 bits."""
    h = mixed & np.uint32(0x3FFFFFFF)
    h ^= h >> 15
    h *= np.uint32(0x2C1B3C6D)
    h &= np.uint32(0x3FFFFFFF)
    h ^= h >> 13
    return h < limit


def word_keys(begin: int, places: np.ndarray) -> np.ndarray:
    """Keys of a document's words, from its own number and their places."""
    h = (begin + places * 0x9E3779B1) & 0xFFFFFFFF
    h = ((h ^ (h >> 16)) * 0x45D9F3B) & 0xFFFFFFFF
    return h ^ (h >> 16)


class Vocabulary:
    """Pieces by text, byte pieces, and every piece's bytes; it travels with the tasks."""

    def __init__(self, path: str = MODEL):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_of = [b""] * n
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        order = sorted((i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))), key=lambda i: (-model.get_score(i), i))
        self.rank = {pieces[i]: r for r, i in enumerate(order)}
        self.ids = {pieces[i]: i for i in order}
        for i in range(n):
            if model.is_byte(i):
                value = int(pieces[i][3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif pieces[i] in self.ids:
                self.bytes_of[i] = pieces[i].replace(BLANK, " ").encode()
        self.sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        order_ids = np.array(order, np.int64)
        self.id_of_rank = order_ids
        pairs = {self.ids[p[:k]] << 15 | self.ids[p[k:]]: self.rank[p] for p in self.ids for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.factors, self.pair_keys, self.pair_ranks = _perfect(pairs)
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        if n > 1 << 15 or any(BLANK in p.lstrip(BLANK) or "\n" in p for p in self.ids):
            raise ValueError("too many pieces, or a piece crosses a blank or a line end")

    def spelled(self, symbol: str) -> list[int]:
        return [self.byte_ids[b] for b in symbol.encode()]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that two pieces make, NONE where they make none; padding is -1."""
        key = (left << 15) | right
        sign = key.view(np.uint32)
        slot = (sign * self.factors[(sign * BUCKET) >> BUCKET_BITS]) >> SLOT_BITS
        return np.where(self.pair_keys[slot] == key, self.pair_ranks[slot], np.int32(NONE))

    def merged_all(self, parts: list[str], keys: list[int], limit: int) -> list[bytes]:
        """``merged`` of many parts, as bytes of 32-bit numbers."""
        flat, begin, size = self.merged_flat(parts, np.array(keys, np.int64), limit)
        return [flat[a : a + n].tobytes() for a, n in zip(begin.tolist(), size.tolist(), strict=True)]

    def merged_flat(self, parts: list[str], key: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``merged`` of many parts in one array, where each begins in it, and its size; parts of like length advance together."""
        size = np.array([len(p) for p in parts], np.int64)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.int32)
        symbols, begin = self.char_ids[codes], np.cumsum(size) - size
        unknown = np.bincount(np.repeat(np.arange(len(parts)), size)[symbols < 0], minlength=len(parts))
        odd = (size > LONG) | (unknown > 0)
        out, order, counts = [np.zeros(0, np.int32)], [np.flatnonzero(odd)], []
        for k in order[0].tolist():
            out.append(np.array(self.merged(parts[k], int(key[k]), limit), np.int32))
        counts.append(np.array([len(x) for x in out[1:]], np.int64))
        even = np.flatnonzero(~odd)
        even = even[np.argsort(size[even], kind="stable")]
        for at in range(0, len(even), ROWS):
            some = even[at : at + ROWS]
            flat, n = self._block(self._grid(symbols, begin[some], size[some]), key[some], limit)
            out.append(flat)
            order.append(some)
            counts.append(n)
        return _placed(out, order, counts)

    def _grid(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Symbols of parts as rows, filled up with -1."""
        across = np.arange(size.max(initial=0))
        inside = across < size[:, None]
        return np.where(inside, symbols[np.where(inside, begin[:, None] + across, 0)], -1)

    def traced(self, parts: list[str], paths: list[tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of each part when the candidates counted in its path are skipped, as ``merged_flat`` gives them; the candidates taken behind them, as the hash adds them, and their numbers.

        For parts of known characters, up to LONG.
        """
        size = np.array([len(p) for p in parts], np.int64)
        symbols, begin = self.char_ids[np.frombuffer("".join(parts).encode("utf-32-le"), np.int32)], np.cumsum(size) - size
        deep = np.array([len(p) for p in paths], np.int64)
        steps = np.fromiter(chain.from_iterable(paths), np.int64, int(deep.sum()))
        below = np.cumsum(deep)
        last = np.full(len(parts), -1)
        last[deep > 0] = steps[below[deep > 0] - 1]
        out, order, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        rows, taken = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        by_size = np.argsort(size, kind="stable")
        for at in range(0, len(by_size), ROWS):
            some = by_size[at : at + ROWS]
            forced = np.zeros((len(some), 1 + max(0, int(last[some].max()))), bool)
            n = deep[some]
            ends = np.cumsum(n)
            forced[np.repeat(np.arange(len(some)), n), steps[np.repeat(below[some] - ends, n) + np.arange(ends[-1])]] = True
            told: list[tuple[np.ndarray, np.ndarray]] = []
            flat, n = self._block(self._grid(symbols, begin[some], size[some]), None, 0, forced, told)
            out.append(flat)
            order.append(some)
            sizes.append(n)
            behind = last[some]
            for step, (row, mixed) in enumerate(told):
                on = step > behind[row]
                rows.append(some[row[on]])
                taken.append(mixed[on])
        row = np.concatenate(rows)
        return *_placed(out, order, sizes), np.concatenate(taken)[np.argsort(row, kind="stable")], np.bincount(row, minlength=len(parts))

    def _block(self, symbols: np.ndarray, key: np.ndarray | None, limit: int, forced: np.ndarray | None = None, told: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of ``symbols`` to its end, one agenda entry of each row at a time.

        ``forced`` says which entries of a row are skipped; ``told`` gets (rows, candidates) of each step.
        """
        n, width = symbols.shape
        symbols = symbols.astype(np.int32)
        final = symbols.copy()
        if limit:
            key = key.astype(np.uint32)
        if width > 1:
            row, place = np.arange(n), np.tile(np.arange(width, dtype=np.int16), (n, 1))
            agenda = self.ranks(symbols[:, :-1], symbols[:, 1:])
            across, step = np.arange(width - 1, dtype=np.int16), -1
            while len(row):
                at = agenda.argmin(axis=1)
                here = np.arange(len(row))
                best = agenda[here, at]
                done = best == NONE
                if done.any():
                    final[row[done]] = symbols[done]
                    go = np.flatnonzero(~done)
                    if not len(go):
                        break
                    row, symbols, place, agenda, at, best = row[go], symbols[go], place[go], agenda[go], at[go], best[go]
                    here = here[: len(go)]
                step += 1
                if told is not None or limit:
                    mixed = place[here, at].astype(np.uint32) * np.uint32(40503) + best.astype(np.uint32) * np.uint32(69621)
                if told is not None:
                    told.append((row, mixed))
                skip = None
                if limit:
                    skip = dropped(key[row] + mixed, limit)
                elif forced is not None and step < forced.shape[1]:
                    skip = forced[row, step]
                if skip is None or not skip.any():
                    symbols, place, agenda = self._merge(symbols, place, agenda, at, best, across)
                    continue
                agenda[here[skip], at[skip]] = NONE
                go = np.flatnonzero(~skip)
                if len(go):
                    symbols[go], place[go], agenda[go] = self._merge(symbols[go], place[go], agenda[go], at[go], best[go], across)
        kept = final >= 0
        return final[kept].astype(np.int32), kept.sum(axis=1)

    def _merge(self, symbols: np.ndarray, place: np.ndarray, agenda: np.ndarray, at: np.ndarray, best: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows with the pair at ``at`` made one piece: what is behind moves up, and the pairs beside it are ranked anew."""
        now = np.arange(len(at))
        behind = across > at.astype(np.int16)[:, None]
        moved = np.empty_like(symbols)
        moved[:, :-1] = np.where(behind, symbols[:, 1:], symbols[:, :-1])
        moved[:, -1] = -1
        moved[now, at] = self.id_of_rank[best]
        places = np.empty_like(place)
        places[:, :-1] = np.where(behind, place[:, 1:], place[:, :-1])
        places[:, -1] = 0
        rest = np.empty_like(agenda)
        rest[:, :-1] = np.where(across[:-1] >= at.astype(np.int16)[:, None], agenda[:, 1:], agenda[:, :-1])
        rest[:, -1] = NONE
        own, right = moved[now, at], np.minimum(at + 1, moved.shape[1] - 1)
        inner = at < rest.shape[1]
        ranks = self.ranks(own, np.where(at + 1 < moved.shape[1], moved[now, right], -1))
        rest[now[inner], at[inner]] = ranks[inner]
        front = np.flatnonzero(at > 0)
        rest[front, at[front] - 1] = self.ranks(moved[front, at[front] - 1], own[front])
        return moved, places, rest

    def merged(self, part: str, key: int = 0, limit: int = 0) -> list[int]:
        """Pieces of a part, blanks as BLANK; ``limit`` is the rate of skipped merges in 2**-30.

        The agenda has an entry for each pair of neighbours: the rank of the piece they
        make, or none.
        """
        if len(part) > LONG:
            return self.merged_long(part, key, limit)
        rank, none = self.rank.get, NONE
        symbols, place = list(part), list(range(len(part)))
        agenda = [rank(a + b, none) for a, b in zip(part, part[1:], strict=False)]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            if limit:
                h = (key + place[i] * 40503 + best * 69621) & 0x3FFFFFFF
                h = (h ^ (h >> 15)) * 0x2C1B3C6D & 0x3FFFFFFF
                if (h ^ (h >> 13)) < limit:
                    agenda[i] = none
                    continue
            symbols[i] += symbols.pop(i + 1)
            del place[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = rank(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = rank(symbols[i - 1] + symbols[i], none)
        return self._numbered(symbols)

    def merged_long(self, part: str, key: int, limit: int) -> list[int]:
        """The same with a heap as agenda, for parts in which looking through a list would take too long."""
        symbols: list[str | None] = list(part)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := self.rank.get(part[i : i + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            r, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right or limit and skipped(key, i, r, limit):
                continue
            symbols[i], symbols[j], after[i] = left + right, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (r := self.rank.get(symbols[a] + symbols[b])) is not None:
                    heapq.heappush(agenda, (r, a, symbols[a], symbols[b]))
        return self._numbered([s for s in symbols if s is not None])

    def _numbered(self, symbols: list[str]) -> list[int]:
        get = self.ids.get
        out = [get(s) for s in symbols]
        if None in out:
            out = [x for s, i in zip(symbols, out, strict=True) for x in (self.spelled(s) if i is None else (i,))]
        return out

    def decoded_all(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of many lists of pieces, one behind the other in ``ids``."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        data = self.blob[np.repeat(self.begins[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        edges = np.concatenate([[0], ends])[offsets].tolist()
        return [data[a + 1 : z].decode(errors="replace") for a, z in zip(edges, edges[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids])[1:].decode(errors="replace")


class Numbers(dict):
    """First nodes of words; a word that is not there gets a number below -1 by its place in ``new``."""

    def __init__(self, front: str, new: list[tuple[Numbers, str]], known: dict[str, int]):
        super().__init__(known)
        self.front, self.new = front, new

    def __missing__(self, word: str) -> int:
        self.new.append((self, word))
        self[word] = number = -1 - len(self.new)
        return number


class Encoder:
    """Encodes texts, remembering words; one for each task."""

    def __init__(self, vocabulary: Vocabulary, seed: int, rate: float):
        self.v, self.seed, self.limit = vocabulary, seed & 0xFFFFFFFF, int(rate * (1 << 30))
        self.end, self.sign = (np.array(vocabulary.spelled(x), np.int32) for x in ("\n", BLANK))
        self.forget()

    def forget(self) -> None:
        #: Words met once so far; first nodes of words, with a blank in front and without.
        self.met: set[str] = set()
        self.new: list[tuple[Numbers, str]] = []
        self.behind, self.plain = Numbers(BLANK, self.new, {}), Numbers("", self.new, {SIGN: 1})
        #: Of each node: part, steps skipped, where its pieces are. The first two are the line end and the blank's sign.
        self.parts, self.paths = ["", ""], [(), ()]
        self.flat, self.at, self.size = Grown(np.int32), Grown(np.int64), Grown(np.int64)
        #: Where a node's candidates begin and how many they are, -1 for parts that are merged anew each time.
        self.begin, self.count = Grown(np.int64), Grown(np.int64)
        #: Of each candidate: what the hash adds, and the node behind its skipping, -1 where it was never met, -2 where once.
        self.taken, self.child = Grown(np.uint32), Grown(np.int32)
        for ids in (self.end, self.sign):
            self._keep(ids, np.array([0]), np.array([len(ids)]))
            self.begin.add(np.array([0]))
            self.count.add(np.array([0]))

    def _keep(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        self.at.add(self.flat.n + begin)
        self.size.add(size)
        self.flat.add(flat)

    def _lines(self, text: str) -> list[tuple[list[str], list[str]]]:
        """(words without a blank in front, words with one) of each line; a literal sign of the blank ends a line for itself."""
        out = []
        for k, line in enumerate(text.split("\n")):
            if BLANK in line or "  " in line or line[:1] == " " or line[-1:] == " ":
                plain = []
                for n, piece in enumerate(line.split(BLANK)):
                    front = BLANK if k == 0 and n == 0 else ""
                    plain += ([SIGN] if n else []) + re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", front + piece.replace(" ", BLANK))
                out.append((plain, []))
            else:
                words = line.split(" ")
                out.append(([], words) if k == 0 else (words[:1] if words[0] else [], words[1:]))
        return out

    def encode_all(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """Each text's pieces as bytes of 32-bit numbers; the keys are the documents'."""
        ids, edges = self.encoded(texts, keys)
        return [ids[a:z].tobytes() for a, z in zip(edges.tolist(), edges[1:].tolist(), strict=False)]

    def encoded(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' pieces, one text behind the other, and their edges."""
        if len(self.parts) > REMEMBERED or len(self.met) > 2 * REMEMBERED:
            self.forget()
        docs = [self._lines(t) if t else [] for t in texts]
        out = []
        for lines in docs:
            found: list[int] = []
            for k, (plain, behind) in enumerate(lines):
                if k:
                    found.append(0)
                found.extend(map(self.plain.__getitem__, plain))
                found.extend(map(self.behind.__getitem__, behind))
            out.append(np.array(found, np.int64))
        size = [len(x) for x in out]
        nodes = np.concatenate([np.zeros(0, np.int64), *out])
        drawn = [word_keys(zlib.crc32(b"%d" % k, self.seed), np.arange(n)) for k, n in zip(keys, size, strict=True)]
        key = np.concatenate([np.zeros(0, np.int64), *drawn])
        # a word met for the first time, and once, is merged by its own draws; nodes are for words that come again
        new = [d.front + w for d, w in self.new]
        single = np.flatnonzero(nodes < 0)
        which = -2 - nodes[single]
        alone = (np.bincount(which, minlength=len(new)) == 1) & ~np.fromiter(map(self.met.__contains__, new), bool, len(new))
        first = np.zeros(len(new), np.int64)
        again = np.flatnonzero(~alone)
        first[again] = self._grow([new[k] for k in again.tolist()], [()] * len(again))
        for (known, word), once, node in zip(self.new, alone.tolist(), first.tolist(), strict=True):
            if once:
                del known[word]
            else:
                known[word] = node
        self.new.clear()
        self.met.update(compress(new, alone.tolist()))
        nodes[single] = first[which]
        once = alone[which]
        single = single[once]
        parts = [new[k] for k in which[once].tolist()]
        if self.limit:
            # parts merged anew each time, and words whose draws were never met before
            odd = np.flatnonzero(self.count.all[nodes] < 0)
            rare = self._walk(nodes, key.astype(np.uint32))
            parts += [self.parts[k] for k in nodes[odd].tolist()] + [self.parts[k] for k in nodes[rare].tolist()]
            single = np.concatenate([single, odd, rare])
        at, n = self.at.all[nodes], self.size.all[nodes]
        own, at_own, n_own = self.v.merged_flat(parts, key[single], self.limit)
        at[single], n[single] = self.flat.n + at_own, n_own
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.concatenate([self.flat.all[: self.flat.n], own])[np.repeat(at - (ends - n), n) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[np.cumsum([0, *size])]

    def _walk(self, nodes: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Lead every word, in place, to the node of its own draws: on to a child where a candidate is skipped.

        Where a child was never met, and is met once, no node is made: those words' places are returned.
        """
        rare = [np.zeros(0, np.int64)]
        open_ = np.flatnonzero(self.count.all[nodes] > 0)
        while len(open_):
            places, slots = [], []
            for at in range(0, len(open_), WORDS):
                some = open_[at : at + WORDS]
                here = nodes[some]
                n = self.count.all[here]
                ends = np.cumsum(n)
                begin = self.begin.all[here] - (ends - n)
                mixed = self.taken.all[np.repeat(begin, n) + np.arange(ends[-1])]
                mixed += np.repeat(key[some], n)
                skip = np.flatnonzero(dropped(mixed, self.limit))
                row = np.searchsorted(ends, skip, side="right")
                first = np.append(True, row[1:] != row[:-1])[: len(row)]
                row = row[first]
                places.append(some[row])
                slots.append(begin[row] + skip[first])
            open_, slot = np.concatenate(places), np.concatenate(slots)
            child = self.child.all[slot]
            new = np.flatnonzero(child < 0)
            code, which, times = np.unique(slot[new], return_inverse=True, return_counts=True)
            lone = (times == 1) & (self.child.all[code] == -1)
            self.child.all[code[lone]] = -2
            alone = new[lone[which]]
            rare.append(open_[alone])
            code, other = code[~lone], new[~lone[which]]
            if len(code):
                above = np.zeros(len(times), np.int64)
                above[which] = nodes[open_[new]]
                above = above[~lone]
                nth = (code - self.begin.all[above]).tolist()
                above = above.tolist()
                steps = [(*p, p[-1] + 1 + k) if (p := self.paths[a]) else (k,) for a, k in zip(above, nth, strict=True)]
                self.child.all[code] = self._grow([self.parts[a] for a in above], steps)
                child[other] = self.child.all[slot[other]]
            go = np.delete(np.arange(len(open_)), alone)
            open_ = open_[go]
            nodes[open_] = child[go]
            open_ = open_[self.count.all[nodes[open_]] > 0]
        return np.concatenate(rare)

    def _grow(self, parts: list[str], paths: list[tuple[int, ...]]) -> range:
        """New nodes: these parts with these steps skipped."""
        made = range(len(self.parts), len(self.parts) + len(parts))
        size = np.array([len(p) for p in parts], np.int64)
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.int32)
        unknown = np.bincount(np.repeat(np.arange(len(parts)), size)[self.v.char_ids[codes] < 0], minlength=len(parts))
        known = (size <= LONG) & (unknown == 0)
        plain, rest = np.flatnonzero(known), np.flatnonzero(~known)
        self.parts += parts
        self.paths += paths
        begin, sizes, candidates, count = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), np.full(len(parts), -1)
        few = parts if len(plain) == len(parts) else [parts[k] for k in plain.tolist()]
        flat, begin[plain], sizes[plain], taken, count[plain] = self.v.traced(few, paths if few is parts else [paths[k] for k in plain.tolist()])
        candidates[plain] = self.taken.n + np.cumsum(count[plain]) - count[plain]
        if not self.limit and len(rest):
            more, at, sizes[rest] = self.v.merged_flat([parts[k] for k in rest.tolist()], np.zeros(len(rest), np.int64), 0)
            begin[rest] = len(flat) + at
            flat = np.concatenate([flat, more])
        self._keep(flat, begin, sizes)
        self.begin.add(candidates)
        self.count.add(count)
        self.taken.add(taken)
        self.child.add(np.full(len(taken), -1, np.int32))
        return made

    def encode(self, text: str, key: int) -> bytes:
        return self.encode_all([text], [key])[0]


def encoded(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: float = DROPOUT, model: str = MODEL, carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, ids): the pieces of each text, one row for each input row."""
    src = df.select(df[id_col].cast("long").alias("id"), *[df[c].alias(f"c{k}") for k, c in enumerate(carried)], utf8(text_col).alias("text"))
    vocabulary = Vocabulary(model)
    kept = [f.name for f in src.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, seed, rate)
        for b in batches:
            found, edges = encoder.encoded(b.column("text").to_pylist(), [-1 if i is None else i for i in b.column("id").to_pylist()])
            ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(found))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), ids], [*kept, "ids"])

    bounded_batches(df.sparkSession)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema if f.name != "text")
    return src.mapInArrow(run, f"{schema}, ids array<int>").toDF(id_col, *carried, "ids")


def decoded(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, ids, text): the text of each row's pieces; null pieces give null."""
    src = df.select(df[id_col].cast("long").alias("id"), df[ids_col].alias("ids"))
    vocabulary = Vocabulary(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1)
            offsets = ids.offsets.to_numpy()
            got = vocabulary.decoded_all(ids.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0])
            texts = [t if known else None for t, known in zip(got, ids.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])

    bounded_batches(df.sparkSession)
    return src.mapInArrow(run, "id long, ids array<int>, text string").withColumnRenamed("id", id_col)
