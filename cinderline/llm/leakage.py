"""Evaluation passages inside training texts: BM25 retrieval with block-max WAND, then verification.

The index is of the test items, which are few; every window of every document queries it. Its terms are words in a row: half a
run for runs, pairs for whole passages (single words for passages too short for that). The thresholds are lower bounds on the score that a leak can have, so
retrieval loses none. Terms whose weights together stay under an item's threshold cannot bring it up alone: only the others, as
the pivot of WAND, open a block of items for a window, and only blocks whose greatest weights reach the threshold are scored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .canonical import LOOKED_AT, codes_of, pieces, skeletons, text_of

MARKS = dict.fromkeys(range(0x300, 0x370))
LINE = 0x0A


def _fold(text: str) -> str:
    return unicodedata.normalize("NFD", text).translate(MARKS).casefold()


@lru_cache(maxsize=1)
def _fold_table() -> tuple[np.ndarray, dict[int, str]]:
    """(code point that each one becomes: without accents and case, a space for what is no letter or digit; those that become several)."""
    to, more = np.arange(0x110000, dtype=np.uint32), {}
    for c in chain(range(0x80), *[range(a, b + 1) for a, b in LOOKED_AT]):
        char = chr(c)
        folded = _fold(char) if not 0xAC00 <= c < 0xE000 else char
        if 0x300 <= c < 0x370:
            folded = ""
        if not any(x.isalnum() for x in folded) and folded:
            folded = " "
        if len(folded) == 1:
            to[c] = ord(folded)
        else:
            more[c] = folded
    to[LINE] = LINE  # between texts
    return to, more


def plain_words(texts: list[str]) -> list[str]:
    """The words of each text with a space between them, see words()."""
    to, more = _fold_table()
    looks = skeletons(texts)
    whole = "\n".join(t.replace("\n", " ") for t in looks)
    codes = to[codes_of(whole)]
    if not whole.isascii() and np.isin(codes, list(more)).any():
        codes = to[codes_of(text_of(codes).translate(more))]
    return text_of(codes).split("\n")


def words(text: str) -> list[str]:
    """Runs of letters and digits, without case, accents, and differences that cannot be seen."""
    return plain_words([text])[0].split()


@dataclass(frozen=True)
class LeakRules:
    run: int = 12  # words of a passage in a row
    changed: float = 0.14  # share of a whole passage's words that may be changed: one in eight, about
    k1: float = 1.2
    b: float = 0.75
    block: int = 8  # items that share an upper bound


@dataclass
class Postings:
    """Inverted index of terms: rows of term `code[t]` stand from start[t] to start[t + 1], in order of item.

    A block row holds the greatest weight of a term among the items of a block, and whether the block is opened by it.
    """

    code: np.ndarray  # in order
    start: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    block_start: np.ndarray
    block: np.ndarray
    block_max: np.ndarray
    opens: np.ndarray
    need: np.ndarray  # least score of a leak, per item
    lowest: np.ndarray  # the same per block
    filter: np.ndarray  # a quick test of codes that are no term
    width: int  # a leak lies in some window of 2 * width words that begins at a multiple of width
    grams: list[int]  # how many words the terms have
    size: int  # items in a block


@dataclass
class LeakIndex:
    """The passages of some items, as numbers of words, and the postings for either kind of leak."""

    items: list
    rules: LeakRules
    vocabulary: dict[str, int]
    passages: list[np.ndarray]
    questions: list[np.ndarray | None]
    run: Postings | None  # runs of words
    whole: Postings | None  # whole passages with changes
    grams: dict[int, set] = field(default_factory=dict, repr=False)  # runs of the items met so far

    def has_run(self, item: int, window: np.ndarray) -> bool:
        n = self.rules.run
        if item not in self.grams:
            p = self.passages[item]
            self.grams[item] = {p[i : i + n].tobytes() for i in range(len(p) - n + 1)}
        return any(window[i : i + n].tobytes() in self.grams[item] for i in range(len(window) - n + 1))


def _hash(code: np.ndarray, bits: int) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _grams(tokens: np.ndarray, n: int) -> np.ndarray:
    """A number for each n words in a row; what is found by it is verified, so that two share one does no harm."""
    out = np.full(max(0, len(tokens) - n + 1), n, np.uint64)
    for k in range(n):
        out = (out + tokens[k : k + len(out)].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _postings(codes: list[np.ndarray], floor, width: int, grams: list[int], rules: LeakRules) -> Postings | None:
    """codes: the terms of each item, repeated as they occur; floor(item, {term: weight}) is the least score of a leak."""
    n = len(codes)
    distinct = [np.unique(c, return_counts=True) for c in codes]
    if not sum(len(c) for c in codes):
        return None
    term, times = (np.concatenate([d[k] for d in distinct]) for k in (0, 1))
    item = np.repeat(np.arange(n), [len(d[0]) for d in distinct])
    size = np.array([len(c) for c in codes])
    code, number, df = np.unique(term, return_inverse=True, return_counts=True)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    weight = idf[number] * times * (rules.k1 + 1) / (times + rules.k1 * (1 - rules.b + rules.b * size[item] / size[size > 0].mean()))
    edge = np.r_[0, np.cumsum([len(d[0]) for d in distinct])]
    need = np.full(n, np.inf)
    opens = np.zeros(len(term), bool)
    for i in np.flatnonzero(size):
        own = slice(edge[i], edge[i + 1])
        need[i] = floor(i, dict(zip(term[own].tolist(), weight[own].tolist())))
        light = np.argsort(weight[own], kind="stable")
        opens[own][light] = np.cumsum(weight[own][light]) >= need[i] * (1 - 1e-9)  # the lighter ones together stay below
    order = np.argsort(number, kind="stable")
    number, item, weight, opens = number[order], item[order], weight[order], opens[order]
    blocks = -(-n // rules.block)
    row, at = np.unique(number * blocks + item // rules.block, return_inverse=True)
    block_max, block_opens = np.zeros(len(row)), np.zeros(len(row), bool)
    np.maximum.at(block_max, at, weight)
    np.logical_or.at(block_opens, at, opens)
    lowest = np.full(blocks, np.inf)
    np.minimum.at(lowest, np.arange(n) // rules.block, need)
    bits = max(12, int(len(code)).bit_length() + 4)
    quick = np.zeros(1 << bits, bool)
    quick[_hash(code, bits)] = True
    starts = lambda numbers: np.searchsorted(numbers, np.arange(len(code) + 1))
    return Postings(code, starts(number), item, weight, starts(row // blocks), row % blocks, block_max, block_opens, need, lowest, quick, width, grams, rules.block)


def build_index(rows: list[tuple], rules: LeakRules = LeakRules()) -> LeakIndex:
    """rows: (item, question or None, passage or None). Items without a word in the passage are left out."""
    kept = [(i, words(q) if q else None, words(p)) for i, q, p in rows if p]
    kept = sorted((r for r in kept if r[2]), key=lambda r: (len(r[2]), str(r[0])))  # like lengths, hence like scores, share a block
    vocabulary: dict[str, int] = {}
    number = lambda ws: np.array([vocabulary.setdefault(w, len(vocabulary)) for w in ws], np.int64)
    passages = [number(p) for _, _, p in kept]
    questions = [number(q) if q else None for _, q, _ in kept]
    half = max(1, rules.run // 2)
    halves, pairs = ([_grams(p, n) for p in passages] for n in (half, 2))
    lost = [int(rules.changed * len(p) + 1e-9) for p in passages]
    # A lost word breaks two pairs, a word put in one; of these an eighth of the passage is allowed for.
    broken = [2 * k + len(p) // 8 + 1 for p, k in zip(passages, lost)]
    short = [b >= len(np.unique(c)) for b, c in zip(broken, pairs)]

    def run_floor(i: int, weight: dict[int, float]) -> float:
        return min(sum(weight[t] for t in set(halves[i][k : k + rules.run - half + 1].tolist())) for k in range(len(passages[i]) - rules.run + 1))

    def whole_floor(i: int, weight: dict[int, float]) -> float:
        return sum(sorted(weight.values(), reverse=True)[lost[i] if short[i] else broken[i] :])

    none = np.zeros(0, np.uint64)
    longest = max((len(p) for p in passages), default=0)
    return LeakIndex(
        [r[0] for r in kept], rules, vocabulary, passages, questions,
        _postings([h if len(p) >= rules.run else none for p, h in zip(passages, halves)], run_floor, rules.run, [half], rules),
        _postings([_grams(p, 1) if s else c for p, c, s in zip(passages, pairs, short)], whole_floor, longest + longest // 4 + 2, [1, 2] if any(short) else [2], rules),
    )


def _spread(start: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of row, place) of all places start[row] to start[row + 1]."""
    count = start[row + 1] - start[row]
    which = np.repeat(np.arange(len(row)), count)
    return which, np.arange(count.sum()) + np.repeat(start[row] - (np.cumsum(count) - count), count)


def retrieve(postings: Postings | None, tokens: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first token, item) of all windows that score at least the item's need.

    tokens: numbers of the words known to the index, -1 elsewhere, of documents of the given lengths one after another. Windows have
    2 * width tokens and begin every width tokens, so width tokens in a row always lie in one.
    """
    none = np.zeros(0, np.int64)
    if postings is None or not len(tokens):
        return none, none, none
    width = postings.width
    doc = np.repeat(np.arange(len(length)), length)
    offset = np.cumsum(length) - length
    unknown = np.r_[0, np.cumsum(tokens < 0)]
    place, last, code = [], [], []
    for n in postings.grams:
        ends = len(tokens) - n + 1
        at = np.flatnonzero((unknown[n:] == unknown[:ends]) & (doc[n - 1 :] == doc[:ends])) if ends > 0 else none
        place.append(at)
        last.append(at + n - 1)
        code.append(_grams(tokens, n)[at])
    place, last, code = np.concatenate(place), np.concatenate(last), np.concatenate(code)
    maybe = postings.filter[_hash(code, int(len(postings.filter)).bit_length() - 1)]
    place, last, code = place[maybe], last[maybe], code[maybe]
    number = np.minimum(np.searchsorted(postings.code, code), len(postings.code) - 1)
    known = postings.code[number] == code
    place, last, number = place[known], last[known], number[known]
    # the two windows that a term may lie in; windows of a document are 0 to top
    windows = np.maximum(1, -(-length // width) - 1)
    first = np.cumsum(windows) - windows
    d = doc[place]
    slot, end = (place - offset[d]) // width, last - offset[d]
    both = []
    for w in (slot, slot - 1):
        ok = (w >= 0) & (w < windows[d]) & (end < (w + 2) * width)
        both.append((first[d[ok]] + w[ok]) * len(postings.code) + number[ok])
    hit = np.unique(np.concatenate(both))
    window, number = hit // len(postings.code), hit % len(postings.code)
    # blocks that some term opens, and of these those whose bound reaches the least need in them
    blocks = len(postings.lowest)
    which, at = _spread(postings.block_start, number)
    pair = window[which] * blocks + postings.block[at]
    open_ = np.unique(pair[postings.opens[at]])
    if not len(open_):
        return none, none, none
    seat = np.minimum(np.searchsorted(open_, pair), len(open_) - 1)
    of = open_[seat] == pair
    bound = np.bincount(seat[of], postings.block_max[at[of]], minlength=len(open_))
    open_ = open_[bound >= postings.lowest[open_ % blocks] * (1 - 1e-9)]
    if not len(open_):
        return none, none, none
    # exact scores in what is left
    some = np.isin(window, open_ // blocks)
    window, number = window[some], number[some]
    which, at = _spread(postings.start, number)
    window, item = window[which], postings.item[at]
    ok = np.isin(window * blocks + item // postings.size, open_)
    found, where = np.unique(window[ok] * len(postings.need) + item[ok], return_inverse=True)
    score = np.bincount(where, postings.weight[at[ok]], minlength=len(found))
    window, item = found // len(postings.need), found % len(postings.need)
    good = score >= postings.need[item] * (1 - 1e-9)
    window, item = window[good], item[good]
    d = np.searchsorted(first, window, side="right") - 1
    return d, offset[d] + (window - first[d]) * width, item


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bits."""
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for y in b.tolist():
        u = v & at.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def whole_match(passage: np.ndarray, window: np.ndarray, rules: LeakRules) -> int:
    """Most words of the passage found in order in a stretch of the window of a quarter more than its length; 0 if too few.

    Stretches begin so close to each other that a passage with words put in, up to an eighth, lies in one.
    """
    n = len(passage)
    least = n - int(rules.changed * n + 1e-9)
    span, step = min(len(window), n + n // 4 + 2), max(1, n // 8)
    if span < least:
        return 0
    known = np.r_[0, np.cumsum(np.isin(window, passage))]
    starts = np.unique(np.r_[np.arange(0, len(window) - span + 1, step), len(window) - span])
    starts = starts[known[starts + span] - known[starts] >= least]
    best = max((common_words(passage, window[s : s + span]) for s in starts.tolist()), default=0)
    return best if best >= least else 0


def _contains(window: np.ndarray, part: np.ndarray | None) -> bool:
    if part is None or not len(part) or len(part) > len(window):
        return False
    at = np.flatnonzero(window[: len(window) - len(part) + 1] == part[0])
    return any((window[i : i + len(part)] == part).all() for i in at)


def find_leaks(index: LeakIndex, texts: list[str | None], folded: bool = False) -> list[tuple[int, int, bool, int, bool]]:
    """(text, item, run, words, question): numbers of text and item, whether a run of the passage is there, how many of its
    words are there if it is there as a whole (with changes), else 0, and whether the item's question is in the text too.
    One row per text and item. folded: the texts are of plain_words()."""
    rules = index.rules
    # very long texts in pieces, so that of their words no more than some are held as strings
    parts = [(i, piece) for i, t in enumerate(texts) for piece in pieces(t or "")]
    length, tokens = np.zeros(len(texts), np.int64), []
    for part in _in_bounds([p for _, p in parts], 2_000_000):
        plain = [p for _, p in parts[part]]
        lists = [p.split() for p in (plain if folded else plain_words(plain))]
        for (i, _), words_ in zip(parts[part], lists):
            length[i] += len(words_)
        tokens.append(np.fromiter(map(index.vocabulary.get, chain.from_iterable(lists), repeat(-1)), np.int64))
    tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
    offset = np.cumsum(length) - length
    found: dict[tuple[int, int], list] = {}
    for d, s, i in zip(*(x.tolist() for x in retrieve(index.run, tokens, length))):
        if index.has_run(i, tokens[s : min(s + 2 * rules.run, offset[d] + length[d])]):
            found.setdefault((d, i), [True, 0])
    for d, s, i in zip(*(x.tolist() for x in retrieve(index.whole, tokens, length))):
        many = whole_match(index.passages[i], tokens[s : min(s + 2 * index.whole.width, offset[d] + length[d])], rules)
        if many:
            was = found.setdefault((d, i), [False, 0])
            was[1] = max(was[1], many)
    return [(d, i, run, many, _contains(tokens[offset[d] : offset[d] + length[d]], index.questions[i])) for (d, i), (run, many) in sorted(found.items())]


def _in_bounds(values: list[str], most: int) -> Iterator[slice]:
    """Slices of values of at most so many characters each (or of one longer value)."""
    at = 0
    while at < len(values):
        end, chars = at, 0
        while end < len(values) and (end == at or chars + len(values[end]) <= most):
            chars += len(values[end])
            end += 1
        yield slice(at, end)
        at = end


def _shards(source: DataFrame, item: str, shard_chars: int) -> list[list[int]]:
    """Hash values of items that together have at most shard_chars characters (a value by itself may have more), and their number as last."""
    chars = F.sum(F.length("p") + F.coalesce(F.length("q"), F.lit(0)))
    total = source.agg(chars).first()[0] or 0
    if total <= shard_chars:
        return [[0, 1]]
    many = 64 * -(-total // shard_chars)
    out, room = [], 0
    for r in source.groupBy(F.pmod(F.xxhash64(F.col(item)), F.lit(many)).alias("h")).agg(chars.alias("n")).collect():
        if r["n"] > room:
            out.append([])
            room = shard_chars
        out[-1].append(r["h"])
        room -= r["n"]
    return [[*hashes, many] for hashes in out]


def leaked_items(
    documents: DataFrame, items: DataFrame, *, key: str, text: str, item: str, passage: str, question: str | None = None, rules: LeakRules = LeakRules(), shard_chars: int = 2_000_000, batch_chars: int = 1_000_000
) -> DataFrame:
    """(key, item, run, words, question_found), one row per document and item that it leaks: run tells whether a run of the
    passage is there, words how many of its words if it is there as a whole, else 0.

    A leak is a run of rules.run words of the passage, or the passage as a whole with at most the allowed share of words
    changed. Case, accents, punctuation, line breaks and differences that cannot be seen do not count. Null, empty and
    blank texts and passages leak nothing; repeated documents or items count once; an empty table gives no rows.

    The documents are not shuffled; only leaks are. The index of the items is broadcast in shards of at most shard_chars
    characters of items (of one hash value of the item beyond that), so its size is bounded: some tens of MB. With more
    than one shard the words of the documents are written once, and each shard is a pass over them.
    """
    spark = documents.sparkSession
    source = items.select(F.col(item), (F.col(question) if question else F.lit(None).cast("string")).alias("q"), F.col(passage).alias("p")).where("p is not null")
    shards = _shards(source, item, shard_chars)
    types = dict(documents.dtypes)[key], dict(items.dtypes)[item]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    out = pa.schema([("k", arrow[types[0]]), ("i", arrow[types[1]]), ("run", pa.bool_()), ("words", pa.int32()), ("question_found", pa.bool_())])
    texts = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull() & (F.col("t") != ""))
    folded = len(shards) > 1
    if folded:

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(1).to_pylist()
                plain = [p for part in _in_bounds(values, batch_chars) for p in plain_words(values[part])]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.string())], names=["k", "t"])

        texts = cut_lineage(texts.mapInArrow(fold, f"k {types[0]}, t string"))
    result = None
    for *hashes, many in shards:
        rows = source if many == 1 else source.where(F.pmod(F.xxhash64(F.col(item)), F.lit(many)).isin(hashes))
        shared = spark.sparkContext.broadcast(build_index(sorted(set(map(tuple, rows.collect())), key=str), rules))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                keys, values = batch.column(0), batch.column(1).to_pylist()
                for part in _in_bounds(values, batch_chars):
                    leaks = find_leaks(index, values[part], folded)
                    names = keys.take(pa.array([part.start + d for d, *_ in leaks], pa.int64()))
                    columns = [[index.items[i] for _, i, *_ in leaks], *[[r[c] for r in leaks] for c in (2, 3, 4)]]
                    yield pa.RecordBatch.from_arrays([names, *[pa.array(c, f.type) for c, f in zip(columns, list(out)[1:])]], schema=out)

        part = texts.mapInArrow(search, f"k {types[0]}, i {types[1]}, run boolean, words int, question_found boolean")
        result = part if result is None else result.unionByName(part)
    return result.groupBy(F.col("k").alias(key), F.col("i").alias(item)).agg(F.max("run").alias("run"), F.max("words").alias("words"), F.max("question_found").alias("question_found"))
