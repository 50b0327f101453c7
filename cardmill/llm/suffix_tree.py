"""Language-model scoring by a probabilistic suffix tree.

Alphabet. Every word of the training texts is a symbol of its own, and so is the end of a text; a word that no training text
has is one of six symbols by its spelling. The alphabet grows with the corpus.

Tree. A state is a context of any length. Contexts and next-symbol counts are candidates from `context_count` and
`pair_count` occurrences on, which are absolute, and all counts are exact. A state is retained where its next symbols diverge from
those of the context one symbol shorter: the log-likelihood gain of its counts must exceed half the logarithm of the token number for
each of them. The tree grows a length at a time until `barren` lengths in a row add less than `share` of its states (0: none at all), a question
round each; there is no limit of length, unless `depth` is given.

Candidates. A context seen T times whose shorter one is seen P times gains T * ln(P / T) at most, and what is longer T / e at most, so
where neither exceeds the penalty of one next symbol its sequences aren't asked for. Where the shorter context always has one successor,
or the longer is seen as often as the shorter, the counts follow from those at hand. Both lose no state.

Smoothing. Counts are discounted by a constant, and the state's rest goes to the distribution of the next shorter state.
A text starts behind an end; contexts don't reach further back. At the root each word is discounted; what that
frees, and half a count, is the probability of an unseen word of its spelling. So the probabilities of all words, unseen ones
and the end sum to 1 in each state, and a token is scored in the longest suffix state of what precedes it.

Passes. Texts are packed once into segments of about `segment` tokens: numbers of words, words by hash, no strings. For one
symbol, for two, and so on a segment asks for the training counts of its distinct sequences (sorted hashes, so eight bytes of shuffle or less each), and
the tasks that own a range of the hashes add up and answer each segment in the order of its question. With the sequences of a length a
segment asks for its contexts of which these counts are known by then, adding what the
sequences it was given to own (each has one owner) say of their divergence; the answer is the retained states. It doesn't ask where it has
seen all repeated sequences of a context itself. With all answers a
segment scores its texts where they lie. Nothing is collected, broadcast or kept by one task for the whole: a question comes once
from each segment, so no word or context is hot, and a task's memory is a segment or `part` questions. Question files go after each
pass; what stays is the segments and the answers, some bits for each token, in buckets by segment.

Hashes. Words are told apart by 80 bits, which the base counts rest on: among m distinct words two meet with a probability of
m * m / 2**81. Sequences are told apart by 64 bits; a false meeting changes one count of the tree.

Nulls: a null text is empty and has its end alone; a null doc_id counts as the text "" in the hold-out rule and stays null.
Repeated rows are scored each. Empty tables give an empty result; with no training text every token is unseen. Extra columns don't
matter. A text of any length lies in one segment.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import arrow_limits, bucketed, documents, dropped_buckets, written
from .words import U, Words, chunks, column, mix, release, retain

CLASSES = 6
_END = U(0xA24BAED4963EE407)
_STEP = U(0x9E3779B97F4A7C15)
_SURE = 1e30
_STATE = 1 << 20  # in place of a length
_SPARSE = 3  # from this length on a segment's state is small beside its texts and travels with the questions


@dataclass(frozen=True)
class Tree:
    context_count: int = 2
    pair_count: int = 2
    depth: int | None = None  # of contexts; None: any
    share: float = 1 / 256  # a length with fewer of the states up to it is barren, as is one without any
    barren: int = 1  # so many barren lengths in a row end the tree
    discount: float = 0.5  # of state counts
    word_discount: float = 0.75  # of words at the root
    segment: int = 1 << 19  # tokens
    part: int = 1 << 21  # questions that one task answers together, about


def spelling(w: Words) -> np.ndarray:
    """Classes of words: whether they hold bytes beyond ASCII, and whether they end in a full stop, another mark or neither."""
    high = np.concatenate(([0], np.cumsum(w.data >= 128)))
    last = w.data[w.ends - 1] if len(w.ends) else np.zeros(0, np.uint8)
    mark = np.where(last == 46, 1, np.where((last >= 33) & (last <= 64) & ~((last >= 48) & (last <= 57)), 2, 0))
    return (high[w.ends] > high[w.starts]) * 3 + mark


def pack(a: np.ndarray) -> bytes:
    """Unsigned values as compressed byte planes: small or sorted values take few bytes."""
    if not len(a):
        return b""
    size = 1 << max(0, (int(a.max()).bit_length() - 1) // 8).bit_length()
    a = a.astype(f"<u{size}", copy=False)
    planes = a.tobytes() if size == 1 else np.ascontiguousarray(a.view(np.uint8).reshape(-1, size).T)
    return bytes([size]) + len(a).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, U)
    size, n = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(memoryview(data)[9:], size * n, "zstd"), np.uint8)
    if size == 1:
        return planes.astype(U)
    out = np.empty(n, f"<u{size}")
    cells = out.view(np.uint8).reshape(n, size)
    for i in range(size):
        cells[:, i] = planes[i * n : (i + 1) * n]
    return out.astype(U, copy=False)


def _bundle(*arrays: np.ndarray) -> bytes:
    parts = [pack(a.astype(U)) for a in arrays]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _unbundle(data: bytes, n: int) -> list[np.ndarray]:
    ends = np.cumsum(np.concatenate(([8 * n], np.frombuffer(data[: 8 * n], "<i8"))))
    return [unpack(data[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def sorting(h: np.ndarray) -> np.ndarray:
    return ordered(h)[0]


def ordered(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """argsort of unsigned values, stable, and the values in that order. Their leading bits and their places are sorted as one number, which takes a fraction of the time;
    hashes that these bits confuse are rare and sorted by themselves."""
    if len(h) < 2:
        return np.arange(len(h)), h
    low, bits = h.min(), (len(h) - 1).bit_length()
    shift = max(0, int(h.max() - low).bit_length() + bits - 64)
    both = h - low
    both >>= U(shift)
    both <<= U(bits)
    both |= np.arange(len(h), dtype=U)
    both.sort()
    both &= U((1 << bits) - 1)
    order = both.view(np.int64)
    x = h[order]
    if (x[1:] < x[:-1]).any():
        order = np.argsort(h, kind="stable")
        x = h[order]
    return order, x


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct value in their order, number of the value at each place)."""
    order, x = ordered(h)
    new = np.ones(len(h), bool)
    new[1:] = x[1:] != x[:-1]
    at = np.empty(len(h), np.int64)
    at[order] = np.cumsum(new) - 1
    return order[new], at


def distinct_words(h: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """distinct() of both."""
    one, at = distinct(h)
    if (h2[one][at] != h2).any():  # two words of one hash
        _, one, at = np.unique(np.stack((h, h2), 1), axis=0, return_index=True, return_inverse=True)
    return one, at.ravel()


def _segments(t: Tree):
    """(seg, words, texts: see Segment for both, more: 16 more bits of the words' hashes and their training counts) of all texts."""

    def bundles(held: list[tuple]) -> tuple[bytes, ...]:
        h, h2, cls, n, learn, ids, has = (np.concatenate(x) for x in zip(*held, strict=True))
        one, at = distinct_words(h, h2)
        often = np.argsort(-np.bincount(at, minlength=len(one)), kind="stable")  # frequent words have small numbers
        rank = np.empty(len(one), np.int64)
        rank[often] = np.arange(len(one))
        counts = np.bincount(at, np.repeat(learn, n.astype(np.int64)), len(one))
        return _bundle(h[one], cls[one], often), _bundle(rank[at], n, learn, ids.view(U), has), _bundle(h2[one] >> U(48), counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        retain()
        seg, held, size = TaskContext.get().partitionId() << 33, [], 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([seg], pa.int64()), *(pa.array([x], pa.binary()) for x in bundles(held))], ["seg", "words", "texts", "more"])
        for b in batches:
            for c in chunks(b):
                w = Words(column(c, "text"), lower=True)
                offs = w.first + np.arange(w.rows + 1)
                place = np.arange(len(w.starts)) + w.doc()
                h, h2, cls = np.full(offs[-1], _END), np.full(offs[-1], _END), np.full(offs[-1], CLASSES, U)
                h[place], h2[place], cls[place] = w.hashes(0), w.hashes(1), spelling(w)
                ids = column(c, "doc_id")
                held.append((h, h2, cls, np.diff(offs).astype(U), np.array(column(c, "learn")).astype(U), ids.fill_null(0).to_numpy(zero_copy_only=False), np.array(ids.is_valid()).astype(U)))
                size += len(h)
                if size >= t.segment:
                    yield row()
                    seg, held, size = seg + 1, [], 0
        if held:
            yield row()
        release()

    return run


@dataclass
class Level:
    """The sequences of a length in a segment, d symbols of context and a token: some tokens, and what is known of each."""

    at: np.ndarray  # the tokens, rising
    total: np.ndarray  # count of the context
    above: np.ndarray  # count of the sequence without its first symbol
    shorter: np.ndarray  # count of the context without its first symbol
    context: np.ndarray  # number of the context
    code: np.ndarray  # hash of the context
    known: np.ndarray  # count of the sequence, where that follows from the others; else 0
    one: np.ndarray  # a place of each distinct sequence, in the order of their hashes
    number: np.ndarray  # of the sequence
    keys: np.ndarray  # hashes of the distinct sequences
    n: np.ndarray | None = None  # count of the sequence
    owned: np.ndarray | None = None  # a place of each distinct sequence over both limits that this segment owns

    def asked(self) -> np.ndarray:
        return self.known[self.one] == 0


class Segment:
    """Some texts as numbers of words, and what is known of their sequences. All counts are those of training."""

    def __init__(self, t: Tree, words: bytes, texts: bytes):
        self.t = t
        self.h, self.cls, often = _unbundle(words, 3)
        tok, n, self.learns, ids, self.has = _unbundle(texts, 5)
        self.tok, self.ids = often.view(np.int64)[tok.view(np.int64)], ids.view(np.int64)
        self.offs = np.concatenate(([0], np.cumsum(n.astype(np.int64))))
        self.row = np.repeat(np.arange(len(n)), n.astype(np.int64))
        self.pos = np.arange(len(tok)) - self.offs[self.row]
        self.learn = self.learns[self.row].astype(bool)
        self.sym = self.h[self.tok]
        self.tokens, self.words = 0, np.zeros(0, np.int64)
        self.levels: list[Level | None] = [None]
        self.states: list[tuple[np.ndarray, np.ndarray]] = []  # answers about the open contexts of each length

    def before(self) -> np.ndarray:
        """The word before each token; a text starts behind an end."""
        out = np.empty(len(self.tok), np.int64)
        out[1:], out[self.offs[:-1]] = self.tok[:-1], self.tok[-1]
        return out

    def extended(self, d: int) -> Level:
        """The sequences of a length that may be of use, without their counts."""
        t = self.t
        if d == 1:
            n, context = self.words[self.tok], self.before()
            total, least = self.words[context], min(t.context_count, t.pair_count)
            at = np.flatnonzero((n >= least) & (total >= least))
            total, above, context = total[at], n[at], context[at]
            shorter, known, code = np.full(len(at), self.tokens), np.zeros(len(at), np.int64), mix(self.h[context])
        else:
            last = self.levels[d - 1]
            place = np.full(len(self.tok), -1)
            place[last.at] = np.arange(len(last.at))
            back = place[last.at - 1]
            least = min(t.context_count, t.pair_count)
            to = np.flatnonzero((self.pos[last.at] >= d - 1) & (back >= 0) & (last.n >= least))
            to = to[last.n[back[to]] >= least]
            back = back[to]
            total, shorter, above = last.n[back], last.total[to], last.n[to]
            limit, most = penalty(self.tokens), np.minimum(total, above)
            use = (above >= t.pair_count) & (total >= t.context_count)
            ask = np.flatnonzero(use & (total <= 2.7 * limit))
            use[ask] = diverges(total[ask], shorter[ask], limit)
            ask = np.flatnonzero(~use & (most >= t.context_count))
            use[ask] = diverges(np.minimum(most[ask], above[ask] / np.e), above[ask], limit)  # it is a context itself
            to, back, total, shorter, above = (x[use] for x in (to, back, total, shorter, above))
            at, context = last.at[to], last.number[back]
            code = mix(last.code[to] * _STEP + self.symbols(at, d))
            known = np.where(total == shorter, above, np.where(above == shorter, total, 0))
        return self.level(at, total, above, shorter, context, code, known)

    def symbols(self, at: np.ndarray, back: int) -> np.ndarray:
        """So many places before some tokens; a text starts behind an end."""
        return np.where(self.pos[at] >= back, self.sym[at - back], _END)

    def level(self, at: np.ndarray, *fields: np.ndarray) -> Level:
        keys = mix(fields[4] * _STEP + self.sym[at])
        one, number = distinct(keys)
        return Level(at, *fields, one, number, keys[one])

    def question(self, x: Level) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the sequences of a length to ask for, and how many of each are in training here."""
        asked = x.asked()
        return x.keys[asked], np.bincount(x.number, self.learn[x.at], len(x.one))[asked].astype(U)

    def carried(self, longer: Level) -> bytes:
        """What the questions behind the next one, about `longer`, rest on: of the sequences one symbol shorter those that are in these or may be
        states, with their counts."""
        x, used = self.levels[-1], np.zeros(len(self.tok), bool)
        used[longer.at] = used[longer.at - 1] = True
        some = used[x.at] | ((x.n >= self.t.context_count) & diverges(x.n, x.above, penalty(self.tokens)))
        at, *counts = (a[some] for a in (x.at, x.total, x.above, x.shorter, x.n))
        return _bundle(np.diff(at, prepend=0), *counts)

    def resumed(self, d: int, data: bytes, value: np.ndarray) -> None:
        """The state of carried() before sequences of d + 1 symbols of context are asked for, with the answer about those of d."""
        steps, total, above, shorter, n = (a.view(np.int64) for a in _unbundle(data, 5))
        at, none = np.cumsum(steps), np.zeros(len(steps), np.int64)
        code = mix(self.symbols(at, 1))
        for i in range(2, d):
            code = mix(code * _STEP + self.symbols(at, i))
        last = self.level(at, total, above, shorter, none, code, none)  # contexts and known counts were of use before the answer
        last.n = n
        self.levels = [None] * (d - 1) + [last]
        self.answered(d, value)

    def answered(self, d: int, value: np.ndarray) -> None:
        n, own = (value >> U(1)).astype(np.int64), (value & U(1)) > 0
        if d == 0:
            self.words = n
            return
        x = self.extended(d)
        asked, counts = x.asked(), x.known[x.one]
        counts[asked] = n
        x.n = counts[x.number]
        x.owned = x.one[asked][own]
        x.owned = x.owned[(x.n[x.owned] >= self.t.pair_count) & (x.total[x.owned] >= self.t.context_count)]
        if last := self.levels[-1]:
            last.total = last.shorter = last.context = last.code = last.known = None  # only the longest has use for these
        self.levels.append(x)

    def contexts(self, d: int) -> tuple[np.ndarray, ...]:
        """(hashes, counts, which may be states, which are open) of the contexts of a length by their numbers.

        Open are those that may have pairs which this segment hasn't seen; the others need no question.
        """
        t, pairs = self.t, self.levels[d]
        if d == 1:
            keys, total, shorter, inner = self.h, self.words, np.full(len(self.words), self.tokens), True
        else:
            x = self.levels[d - 1]
            keys, total, shorter, inner = x.keys, x.n[x.one], x.above[x.one], self.sym[x.at[x.one]] != _END
        may = (total >= t.context_count) & inner
        ask = np.flatnonzero(may)
        may[ask] = diverges(total[ask], shorter[ask], penalty(self.tokens))
        seen = np.bincount(pairs.context[pairs.one], pairs.n[pairs.one], len(total))
        return keys, total, may, may & (total - seen >= max(t.pair_count, 1))

    def divergence(self, d: int, pairs: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        """What some sequences say of their contexts: how many they are, their counts and their gain."""
        x = self.levels[d]
        n, at = x.n[pairs], x.context[pairs]
        gain = np.bincount(at, n * np.log(n / x.total[pairs] * (x.shorter[pairs] / x.above[pairs])), size)
        return np.bincount(at, minlength=size), np.bincount(at, n, size).astype(np.int64), gain

    def open_contexts(self, d: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The question of contexts: those to ask for, and others of which this segment owns sequences, in the order of their
        hashes; with what the owned sequences say."""
        keys, total, may, open_ = self.contexts(d)
        kinds, paired, gain = self.divergence(d, self.levels[d].owned, len(keys))
        # whose sequences are all owned here is judged here: it is sent as a state beyond doubt, or not at all
        whole = (kinds > 0) & (total - paired < self.t.pair_count)
        state = gain > penalty(self.tokens) * kinds
        none = ~may | (whole & ~state)
        kinds[none] = paired[none] = 0
        gain[whole | none] = np.where(state & whole & may, _SURE, 0)[whole | none]
        send = np.flatnonzero(open_ | (kinds > 0))
        send = send[sorting(keys[send])]
        return keys[send], [kinds[send].astype(U) << U(1) | open_[send].astype(U), paired[send].astype(U), gain[send].astype("<f4").view("<u4").astype(U)]

    def probabilities(self, roots: Callable, values: list[np.ndarray]) -> np.ndarray:
        """Of each token in the longest state before it. values: the answers about sequences of one word, of two and so on, which are taken here, so that
        no more than two lengths are held."""
        t, p = self.t, roots(self.cls.astype(np.int64), self.words)[self.tok]
        for d, (kinds, paired) in enumerate(self.states, 1):
            self.answered(d, values[d])
            x, self.levels[: d - 1] = self.levels[d], [None] * (d - 1)
            keys, total, may, open_ = self.contexts(d)
            k, c, gain = self.divergence(d, x.one[(x.n[x.one] >= t.pair_count) & (x.total[x.one] >= t.context_count)], len(keys))
            k[~may | (gain <= penalty(self.tokens) * k)] = 0
            order = np.flatnonzero(open_)
            order = order[sorting(keys[order])]
            k[order], c[order] = kinds, paired
            if d == 1:
                at = self.before()
                token = np.flatnonzero(k[at] > 0)
                at = at[token]
            else:
                last = self.levels[d - 1]
                state = k[last.number] > 0
                token, at = last.at[state] + 1, last.number[state]
            n = np.zeros(len(self.tok), np.int64)
            n[x.at] = x.n
            n = n[token]
            rest = 1 - (c[at] - t.discount * k[at]) / total[at]
            p[token] = np.where(n >= t.pair_count, (n - t.discount) / total[at], 0.0) + rest * p[token]
        return p


def diverges(total: np.ndarray, shorter: np.ndarray, limit: float) -> np.ndarray:
    """Whether contexts may gain more than the limit over those one symbol shorter, whatever follows them."""
    return total * np.log(np.maximum(shorter, 1) / np.maximum(total, 1)) > limit * (1 - 1e-6)


def penalty(tokens: int) -> float:
    return 0.5 * float(np.log(max(tokens, 2)))


_ROW = "seg long, level int, part int, a binary, b binary, n long, types long"
_ROW_SCHEMA = pa.schema([("seg", pa.int64()), ("level", pa.int32()), ("part", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64()), ("types", pa.int64())])
_ASK = "part int, level int, seg long, keys binary, x binary, y binary, z binary"
_ASK_SCHEMA = pa.schema([("part", pa.int32()), ("level", pa.int32()), ("seg", pa.int64()), *((c, pa.binary()) for c in ("keys", "x", "y", "z"))])


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), 500):
        yield pa.RecordBatch.from_arrays([pa.array(c, s) for c, s in zip(zip(*rows[i : i + 500], strict=True), schema.types, strict=True)], schema=schema)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple]]]:
    """Questions of each part and level, which come together."""
    now, held = None, []
    for b in batches:
        for part, level, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (part, level) != now:
                if held:
                    yield *now, held
                now, held = (part, level), []
            held.append(tuple(row))
    if held:
        yield *now, held


def _read(t: Tree, batches: Iterator[pa.RecordBatch], tokens: int, lengths: int, states: int, taken: int | None = None) -> Iterator[tuple[int, Segment, list[np.ndarray]]]:
    """Each segment with the answers about the sequences of some lengths, of which it has taken all or the first, and the contexts of some."""
    retain()
    for batch in batches:
        for seg, words, texts, answers in zip(*(column(batch, c).to_pylist() for c in ("seg", "words", "texts", "answers")), strict=True):
            yield seg, *_informed(Segment(t, words, texts), answers or [], tokens, lengths, states, lengths if taken is None else taken)


def _informed(segment: Segment, answers: list[dict], tokens: int, lengths: int, states: int, taken: int) -> tuple[Segment, list[np.ndarray]]:
    out: dict[int, list] = {}
    for x in sorted((x for x in answers if x["level"] != _STATE), key=lambda x: (x["level"], x["part"])):
        out.setdefault(x["level"], []).append((unpack(x["a"]), unpack(x["b"] or b"")))
    both = {level: [np.concatenate(x) for x in zip(*rows, strict=True)] for level, rows in out.items()}
    none = [np.zeros(0, U)] * 2
    segment.tokens = tokens
    if data := [x["a"] for x in answers if x["level"] == _STATE]:
        segment.resumed(lengths - 1, data[0], both.get(lengths - 1, none)[0])
    else:
        for d in range(taken):
            segment.answered(d, both.get(d, none)[0])
    segment.states = [tuple(x.view(np.int64) for x in both.get(-d, none)) for d in range(1, states + 1)]
    return segment, [both.get(d, none)[0] for d in range(lengths)]


def _asked(level: int, seg: int, parts: int, keys: np.ndarray, *fields: np.ndarray) -> Iterator[pa.RecordBatch]:
    part, rows = ((keys >> U(32)) * U(parts)) >> U(32), []
    cut = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)])) if len(part) else np.zeros(1, int)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        rows.append((int(part[a]), level, seg, pack(keys[a:b]), *(pack(f[a:b]) for f in fields), *[None] * (3 - len(fields))))
    yield from _batch(rows, _ASK_SCHEMA)


def _word_questions(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg, words, more in zip(*(column(batch, c).to_pylist() for c in ("seg", "words", "more")), strict=True):
                h, cls, _ = _unbundle(words, 3)
                h2, counts = _unbundle(more, 2)
                yield from _asked(0, seg, parts, h, counts, h2, cls)

    return run


def _questions(t: Tree, levels: list[int], parts: int, tokens: int, lengths: int):
    """Of sequences of a length, and of contexts: their lengths are negative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seg, s, _ in _read(t, batches, tokens, lengths, 0):
            for level in levels:
                if level > 0:
                    x = s.extended(level)
                    yield from _asked(level, seg, parts, *s.question(x))
                    if level >= _SPARSE:  # its state comes back with the answers
                        yield from _batch([((seg + (seg >> 33)) % parts, _STATE, seg, s.carried(x), None, None, None)], _ASK_SCHEMA)
                else:
                    keys, fields = s.open_contexts(-level)
                    yield from _asked(level, seg, parts, keys, *fields)
        release()

    return run


def _answers(tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        retain()
        for part, level, rows in _grouped(batches):
            if level == _STATE:
                yield from _batch([(seg, level, part, data, None, None, None) for seg, data, *_ in rows], _ROW_SCHEMA)
                continue
            fields = [[unpack(r[i] or b"") for r in rows] for i in range(1, 5)]
            ends = np.cumsum([0, *(len(k) for k in fields[0])])
            keys, x, y, z = (np.concatenate(f) for f in fields)
            order = sorting(keys)
            new = np.ones(len(keys), bool)
            new[1:] = keys[order][1:] != keys[order][:-1]
            if level == 0 and (~new[1:] & (y[order][1:] != y[order][:-1])).any():  # two words of one hash
                order = np.lexsort((y, keys))
                new[1:] = (keys[order][1:] != keys[order][:-1]) | (y[order][1:] != y[order][:-1])
            first, group = np.flatnonzero(new), np.cumsum(new) - 1
            out, a, b, asked = [], np.empty(len(keys), U), None, np.ones(len(keys), bool)
            if level >= 0:
                total = np.add.reduceat(x[order], first)
                a[order] = (total[group] << U(1)) | new.astype(U)  # one of those that ask owns it
            else:
                asked, b = (x & U(1)) > 0, np.empty(len(keys), U)
                kinds, paired = np.add.reduceat((x >> U(1))[order], first), np.add.reduceat(y[order], first)
                gain = np.add.reduceat(z.astype("<u4").view("<f4").astype(float)[order], first)
                kept = gain > penalty(tokens) * kinds  # without pairs neither is over the other
                a[order], b[order] = np.where(kept, kinds, 0)[group], np.where(kept, paired, 0)[group]
            if level:  # how many sequences were asked for, or contexts retained
                out.append((-1 - part, level, part, None, None, int(len(first) if level > 0 else kept.sum()), 0))
            if level == 0:
                cls = z[order][first].astype(np.int64)
                n, types = np.bincount(cls, total, CLASSES + 1), np.bincount(cls, total > 0, CLASSES + 1)
                out += [(-1 - part, c, part, None, None, int(n[c]), int(types[c])) for c in range(CLASSES + 1)]
            for i, r in enumerate(rows):
                own = slice(ends[i], ends[i + 1])
                out.append((r[0], level, part, *(None if v is None else pack(v[own][asked[own]]) for v in (a, b)), None, None))
            yield from _batch(out, _ROW_SCHEMA)
        release()

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(t: Tree, tokens: int, types: np.ndarray, states: int):
    """types: how many words of each spelling training has, and 1 for the end."""
    unseen = np.append(t.word_discount * types[:CLASSES] + 0.5, 0.5)
    mass, words = tokens + 0.5 * (CLASSES + 1), int(types.sum())

    def roots(cls: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(cls == CLASSES, n + 0.5, np.where(n > 0, n - t.word_discount, unseen[cls])) / mass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, s, values in _read(t, batches, tokens, states + 1, states, 1):
            p = s.probabilities(roots, values)
            by_row = lambda x: np.bincount(s.row, x, len(s.ids))
            n = np.diff(s.offs)
            base = by_row(np.log10(s.words + 1.0)[s.tok]) - n * np.log10(tokens + words + 1)
            cols = [pa.array(s.ids, mask=s.has == 0), pa.array(s.learns == 0), pa.array(n), pa.array(by_row(s.words[s.tok] > 0).astype(np.int64)), pa.array(np.full(len(n), tokens)), pa.array(base), pa.array(by_row(np.log10(p)))]
            out = pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in _SCORES.split(", ")])
            for a in range(0, out.num_rows, 50_000):
                yield out.slice(a, 50_000)
        release()

    return run


def score_documents(docs: DataFrame, learn, t: Tree = Tree()) -> DataFrame:
    """Score every row of docs by a tree of the rows where the column learn is true.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, as a written table.
    """
    spark = docs.sparkSession
    arrow_limits(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count, least = size // (6 * t.segment) + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))  # about six bytes a token
    parts = max(least, count * t.segment // t.part)
    tasks = lambda n: max(least, min(n, 20_000 + n // 8))
    # Segments and answers lie in the same buckets, about four segments in each, so they meet without moving again.
    buckets = tasks(-(-count // 4))
    segs = bucketed(rows.mapInArrow(_segments(t), "seg long, words binary, texts binary, more binary"), "segments", "seg", buckets)
    answers: list[DataFrame] = []

    def known(tables: list[DataFrame]) -> DataFrame:
        out, names = segs.drop("more"), [f"answers{i}" for i in range(len(tables))]
        for name, table in zip(names, tables, strict=True):
            got = table.groupBy("seg").agg(F.collect_list(F.struct("level", "part", "a", "b")).alias(name))
            out = out.hint("merge").join(got, "seg", "left")
        none = F.array().cast("array<struct<level:int,part:int,a:binary,b:binary>>")
        return out.select("seg", "words", "texts", F.concat(*(F.coalesce(n, none) for n in names)).alias("answers"))

    def ask(levels: list[int]) -> dict[int, tuple[int, int]]:
        tables = [x.filter("seg >= 0") for x in answers]
        if len(tables) > _SPARSE:
            tables = tables[-1:]
        else:
            tables = [x.filter(F.col("level") != _STATE) for x in tables]
        asked = known(tables).mapInArrow(_questions(t, levels, parts, tokens, len(answers)), _ASK) if answers else segs.select("seg", "words", "more").mapInArrow(_word_questions(parts), _ASK)
        told = asked.repartition(tasks(parts), "part").sortWithinPartitions("part", "level", "seg").mapInArrow(_answers(tokens), _ROW)
        answers.append(bucketed(told, f"answers{len(answers)}", "seg", buckets))
        sums = answers[-1].filter("seg < 0").groupBy("level").agg(F.sum("n").alias("n"), F.sum("types").alias("types"))
        return {r.level: (r.n, r.types) for r in sums.collect()}  # a row for each spelling, or for each question

    tokens, types, states = 0, np.zeros(CLASSES + 1, np.int64), 0
    for c, (n, kinds) in ask([0]).items():
        tokens, types[c] = tokens + n, kinds
    if tokens and t.depth != 0:
        ask([1])
        fruitful = size = 0
        for d in itertools.count(2):
            more = t.depth is None or d <= t.depth
            found = ask([d, 1 - d] if more else [1 - d]).get(1 - d, (0, 0))[0]
            size += found
            if found:
                states = d - 1
            if found and found >= t.share * size:
                fruitful = d - 1
            if not more or d - 1 - fruitful >= t.barren:
                break
    out = written(known([x.filter((F.col("seg") >= 0) & (F.col("level") != _STATE)) for x in answers]).mapInArrow(_scored(t, tokens, types, states), _SCORES), "scores")
    for x in (segs, *answers):
        dropped_buckets(x)
    return out


def op1_suffix_tree_scores(spark, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 != 2
    return score_documents(documents(spark, sf_dir), learn)
