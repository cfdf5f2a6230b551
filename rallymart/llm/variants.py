"""Spelling variants: words one edit apart, found in sorted lists by dynamic programming.

A word is compared with a sorted list by the rows of its edit matrix, of which one edit needs three
cells. A row depends on a prefix of the list's word alone, so words with a common prefix (by the
LCPs of neighbours in the list) share the rows of that prefix, and all words whose shared prefix is
already more than one edit away are skipped. `near_in_lists` does this for many words and lists at
once, one character of depth after another.

No list holds the whole vocabulary. With one edit between a word of `base` characters and one of as
many or one more, the first half of the shorter word is also the start of the other, or its second
half the end of the other. So each list holds the words of two lengths that share a half, as they
are or read backwards, and the rows begin behind the shared half. Lists of more than `MOST_IN_LIST`
words are dealt into chunks, and each two chunks make a list.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_pass, lower_ascii, stage

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is at least as many times as frequent.
RATIO = 10
#: One in so many occurrences loses a character.
THINNED = 31
MOST_IN_LIST = 20_000
#: Words that go through their lists at once; bounds memory only.
AT_ONCE = 8192


def occurrences(docs: DataFrame) -> DataFrame:
    """`word` of each run of letters in whole texts, in lower case, some with one character left out.

    Runs that are shorter than `LEAST_LENGTH` are left out at once, as no word comes from them.
    """
    runs = F.regexp_extract_all("text", F.lit(f"({LETTERS}{{{LEAST_LENGTH},}})"), F.lit(1))
    run = lower_ascii(F.col("run"))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = (F.col("hash") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.length("run")))
    return (
        docs.select("doc_id", F.explode(runs).alias("run"))
        .select("doc_id", run.alias("run"))
        .select("run", F.crc32(key).alias("hash"))
        .select(F.when(F.col("hash") % THINNED == 0, cut).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= LEAST_LENGTH)
    )


def _lists(base: Column, word: Column) -> list[Column]:
    """The two lists of words of `base` and `base + 1` characters that `word` belongs to."""
    half = F.floor(base / 2).cast("int")
    rest = (base - half).cast("int")
    start = F.substring(word, 1, half)
    end = F.substring(word, F.length(word) - rest + 1, rest)
    return [
        F.struct(base.alias("base"), F.lit(side).alias("side"), part.alias("part"))
        for side, part in ((0, start), (1, end))
    ]


def near_words(words: DataFrame, most: int = MOST_IN_LIST) -> DataFrame:
    """From distinct `word`, `n`: `word`, `near`, `near_n` for all words one edit apart, both ways."""
    word, size = F.col("word"), F.length("word")
    shorter = F.when(size > LEAST_LENGTH, size - 1)
    lists = F.array(*_lists(size, word), *_lists(shorter, word))
    dealt = words.select("word", "n", F.inline(lists)).where("base IS NOT NULL")
    key = ["base", "side", "part"]
    large = dealt.groupBy(*key).count().where(F.col("count") > most)
    chunks = F.coalesce(F.ceil(F.col("count") / most), F.lit(1)).cast("int")
    mine, other = F.col("mine"), F.col("other")
    members = (
        dealt.join(large, key, "left")
        .select(*key, "word", "n", chunks.alias("chunks"))
        .withColumn("mine", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .groupBy(*key, F.least(mine, other).alias("low"), F.greatest(mine, other).alias("high"))
        .agg(F.collect_list(F.struct("word", "n", "mine")).alias("members"))
        .where(F.size("members") > 1)
        .select(
            "base",
            "side",
            (F.col("low") != F.col("high")).alias("across"),
            F.col("members.word").alias("words"),
            F.col("members.n").alias("counts"),
            F.col("members.mine").alias("chunks"),
        )
    )

    def work():
        def each(batch: pa.RecordBatch) -> dict:
            lists = batch.column("words")
            sizes = np.diff(lists.offsets.to_numpy())
            words = lists.flatten().to_pylist()
            counts = batch.column("counts").flatten().to_numpy()
            chunks = batch.column("chunks").flatten().to_numpy()
            of_list = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("base", "side")]
            a, b = near_in_lists(words, sizes, *of_list)
            across = np.repeat(batch.column("across").to_numpy(zero_copy_only=False), sizes)
            told = ~across[a] | (chunks[a] != chunks[b])
            a, b = a[told], b[told]
            return {
                "word": [words[i] for i in a.tolist()],
                "near": [words[i] for i in b.tolist()],
                "near_n": counts[b],
            }

        return each

    return arrow_pass(members, work, "word string, near string, near_n long")


def near_in_lists(
    words: Sequence[str], sizes: np.ndarray, bases: np.ndarray, sides: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places `a`, `b` in `words` of all pairs one edit apart within a list, both ways.

    `words` holds the lists one after another, of `sizes` words each. A list of side 0 shares the
    first `base // 2` characters, one of side 1 the last `base - base // 2`; what the two lists
    of a pair both hold is told by side 0 alone.
    """
    if not len(words):
        return np.zeros(0, "int64"), np.zeros(0, "int64")
    # Lists of the same kind come together, the words of each sorted, backwards on side 1.
    rank = np.empty(len(sizes), "int64")
    rank[np.lexsort((sides, bases))] = np.arange(len(sizes))
    spelt = list(words)
    at = 0
    for size, side in zip(sizes.tolist(), sides.tolist(), strict=True):
        if side:
            spelt[at : at + size] = [w[::-1] for w in spelt[at : at + size]]
        at += size
    of_list = np.repeat(rank, sizes).tolist()
    order = sorted(range(len(words)), key=lambda i: (of_list[i], spelt[i]))
    codes = np.frombuffer("".join([spelt[i] for i in order]).encode("utf-32-le"), "<u4")
    lengths = np.array([len(spelt[i]) for i in order])
    starts = np.cumsum(lengths) - lengths
    lists = np.array([of_list[i] for i in order])
    by_rank = np.argsort(rank)
    kinds = (bases * 2 + sides)[by_rank][lists]
    edges = np.flatnonzero(np.diff(kinds, prepend=-1, append=-1))
    order = np.array(order)
    found = [(np.zeros(0, "int64"), np.zeros(0, "int64"))]
    for lo, hi in zip(edges, edges[1:], strict=False):
        base, side = divmod(int(kinds[lo]), 2)
        scan = _Scan(codes, starts[lo:hi], lengths[lo:hi], lists[lo:hi], base, side)
        a, b = scan.pairs()
        found.append((order[lo + a], order[lo + b]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class _Scan:
    """Sorted lists of one base length and side, and the search of all their words in them."""

    def __init__(self, codes, starts, lengths, lists, base: int, side: int) -> None:
        self.codes, self.starts, self.lengths, self.base, self.side = codes, starts, lengths, base, side
        self.first = base - base // 2 if side else base // 2
        n = len(starts)
        opens = np.diff(lists, prepend=-1) != 0
        self.list_start = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        self.list_end = np.append(np.flatnonzero(opens), n)[np.cumsum(opens)]
        #: Characters that each word shares with the one before it in its list.
        self.lcp = np.where(opens, 0, self.first)
        left = np.flatnonzero(~opens)
        for depth in range(self.first, base + 1):
            longer = (lengths[left] > depth) & (lengths[left - 1] > depth)
            left = left[longer]
            left = left[codes[starts[left] + depth] == codes[starts[left - 1] + depth]]
            if not len(left):
                break
            self.lcp[left] = depth + 1

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        asked = np.flatnonzero(self.lengths == self.base)
        found = [self._search(asked[i : i + AT_ONCE]) for i in range(0, len(asked), AT_ONCE)]
        a = np.concatenate([x for x, _ in found] or [asked])
        b = np.concatenate([x for _, x in found] or [asked])
        if self.side:
            new = self._starts_differ(a, b)
            a, b = a[new], b[new]
        # Words of the base length found each other both ways.
        one_way = self.lengths[b] > self.base
        return np.concatenate([a, b[one_way]]), np.concatenate([b, a[one_way]])

    def _starts_differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words, read forwards, differ in their first half."""
        same = np.ones(len(a), bool)
        last_a, last_b = self.starts[a] + self.lengths[a] - 1, self.starts[b] + self.lengths[b] - 1
        for i in range(self.base // 2):
            same &= self.codes[last_a - i] == self.codes[last_b - i]
            if not same.any():
                break
        return ~same

    def _char(self, word: np.ndarray, depth: int) -> np.ndarray | int:
        """The characters of words of the base length; none behind the end."""
        return self.codes[self.starts[word] + depth] if depth < self.base else 0

    def _search(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Asked words `a` and what they find, `b`.

        Each entry is a word, a range of the list whose words share `depth` characters, and the
        cells of the matrix row behind these, for one character less of the asked word, as many
        and one more.
        """
        base = self.base
        word, lo, hi = asked, self.list_start[asked], self.list_end[asked]
        less = np.ones(len(asked), "int8")
        even, more = np.zeros(len(asked), "int8"), np.ones(len(asked), "int8")
        found = []
        for depth in range(self.first, base + 2):
            if not len(word):
                break
            if depth >= base:
                ends = self.lengths[lo] == depth
                hit = ends & (even == 1 if depth == base else less <= 1)
                found.append((word[hit], lo[hit]))
                if depth > base:
                    break
            # Ranges that share one character more begin where the LCP allows no more than this.
            opens = np.flatnonzero((self.lcp <= depth) & (self.lengths > depth))
            a, b = np.searchsorted(opens, lo), np.searchsorted(opens, hi)
            parent = np.repeat(np.arange(len(word)), b - a)
            child = np.arange(len(parent)) + np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a)
            word, hi = word[parent], hi[parent]
            lo = opens[child]
            hi = np.minimum(np.append(opens, len(self.lcp))[child + 1], hi)
            char = self.codes[self.starts[lo] + depth]
            less, even, more = less[parent], even[parent], more[parent]
            new_less = np.minimum(even + 1, less + (char != self._char(word, depth - 1)))
            new_even = np.minimum(even + (char != self._char(word, depth)), np.minimum(more, new_less) + 1)
            new_more = np.minimum(more + (char != self._char(word, depth + 1)), new_even + 1)
            if depth + 1 > base:
                new_even = np.full_like(new_even, 9)
            if depth + 2 > base:
                new_more = np.full_like(new_more, 9)
            keep = (new_less <= 1) | (new_even <= 1) | (new_more <= 1)
            word, lo, hi = word[keep], lo[keep], hi[keep]
            less, even, more = new_less[keep], new_even[keep], new_more[keep]
        found = found or [(asked[:0], asked[:0])]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def group_variants(docs: DataFrame, most: int = MOST_IN_LIST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the documents' whole texts.

    Words have at least `LEAST_LENGTH` characters and `LEAST_COUNT` occurrences (n). A word's form
    is the most frequent word one edit away, of equals the smallest, if it is `RATIO` times as
    frequent; its root is where forms lead. Null and empty texts have no words; a null doc_id counts
    as empty text in the hash; repeated rows count each; an empty table gives no rows; other columns
    are not read. Words of any length take part.
    """
    counted = occurrences(docs.select("doc_id", "text")).groupBy("word").agg(F.count("*").alias("n"))
    words = stage(counted.where(F.col("n") >= LEAST_COUNT), "words")
    near = near_words(words, most).groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"),
    )
    is_form = -F.col("best.rank") >= RATIO * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.rank")).alias("form_n"),
    )
    known = stage(known, "variants")
    # Each step to a form multiplies n by RATIO, so the longest way is known; steps double it.
    most_n = words.agg(F.max("n")).first()[0] or 1
    longest = max(1, int(math.log(most_n, RATIO)) + 1)
    roots = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest + 1))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stage(
            roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "roots",
        )
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
