"""Phrases whose words stand together more often than their parts explain.

Each task turns its texts into windows of up to four words, one from every word on, and
builds a weighted automaton of them for each shard of bounded size. The automata are cut
at the borders of prefix ranges; the owner of a range unites them and sums their weights.
A beginning that a border divides has part of its weight in each range, so these are sent
on whatever their weight, and everything else only if it is frequent. The parts of a
candidate are looked up by composing an automaton of asked phrases with one of counts.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.automata import DEPTH, Automaton, levels, sorted_counts, union
from storelake.llm.common import text_of, written

LEAST, TOP, SCALE = 30, 2000, 2_000_000
#: A longer candidate with this share (in hundredths) of a phrase's places stands for it.
COVERS = 80
#: Words of a shard, and about how many words' windows one owner unites.
SHARD_WORDS, RANGE_WORDS = 1 << 20, 1 << 20
#: The borders come from the windows of at most so many texts of at most so many
#: characters, drawn at random. They decide who owns what, not what comes out.
BORDER_DOCS, BORDER_CHARS = 1000, 20_000
#: Phrases of one lookup task; copies of each count, so that a part that many
#: candidates share is looked up in several tasks.
LOOKUP_ROWS, SALTS = 200_000, 8
NO_LANG = "und"

_ENDS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes.maketrans(
    bytes(range(65, 91)) + _ENDS + b"\t", bytes(range(97, 123)) + b"." * len(_ENDS) + b" "
)


def tokens(text: bytes) -> list[bytes]:
    """The words in order, with b"." wherever a piece ends."""
    return text.translate(_LOWER).replace(b".", b" . ").split()


class Vocabulary(dict):
    """Numbers words in the order in which they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number

    def numbers(self, text: bytes) -> np.ndarray:
        found = tokens(text)
        out = np.fromiter(map(self.__getitem__, found), np.int32, len(found))
        return np.append(out, np.int32(0))


def windows_of(vocabulary: Vocabulary, texts: list[np.ndarray]):
    """Sorted words, sorted distinct windows of labels, and their counts."""
    ids = np.concatenate(texts)
    names = list(vocabulary)
    present = np.unique(ids)
    words = sorted(names[i] for i in present[present > 0].tolist())
    label = np.zeros(len(names), np.int32)
    label[[vocabulary[w] for w in words]] = np.arange(1, len(words) + 1, dtype=np.int32)
    ranks = np.concatenate([label[ids], np.zeros(DEPTH, np.int32)])
    at = np.flatnonzero(ranks)
    windows = np.zeros((len(at), DEPTH), np.int32)
    windows[:, 0] = ranks[at]
    for d in range(1, DEPTH):  # an ended window stays ended
        windows[:, d] = np.where(windows[:, d - 1] > 0, ranks[at + d], 0)
    return words, *sorted_counts(windows)


def _key(words: list[bytes], window: np.ndarray) -> tuple[bytes, ...]:
    return tuple(words[i - 1] for i in window.tolist() if i)


class _Keys:
    """Sorted windows as a sequence of word tuples, for bisection."""

    def __init__(self, words, windows):
        self.words, self.windows = words, windows

    def __len__(self):
        return len(self.windows)

    def __getitem__(self, i):
        return _key(self.words, self.windows[i])


def cuts(borders: list[tuple], lang: str, words, windows) -> list[tuple[int, int, int]]:
    """(range, first row, end row) of the windows of one language, for ranges that hold any.

    ``borders`` are sorted (lang, words); range i holds what is from border i - 1 up to,
    and without, border i.
    """
    out, start, keys = [], 0, _Keys(words, windows)
    first = bisect_left(borders, (lang,))
    for i in range(first, len(borders)):
        if start == len(windows):
            break
        end = len(windows) if borders[i][0] != lang else bisect_left(keys, borders[i][1], start)
        if end > start:
            out.append((i, start, end))
        start = end
        if borders[i][0] != lang:
            break
    if start < len(windows):
        out.append((len(borders), start, len(windows)))
    return out


def find_borders(sample: list[tuple[str, str]], ranges: int) -> list[tuple]:
    """At most ``ranges`` - 1 sorted (lang, words), evenly spaced among sampled windows."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in sample:
        by_lang.setdefault(lang, []).append(text)
    keys = []
    for lang in sorted(by_lang):
        v = Vocabulary()
        words, windows, _ = windows_of(v, [v.numbers(t.encode()) for t in by_lang[lang]])
        keys += [(lang, _key(words, w)) for w in windows]
    if not keys:
        return []
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})


def shard_automata(texts: DataFrame, borders: list[tuple], shard_words: int) -> DataFrame:
    """(range, lang, body): for every shard, language and range an automaton as bytes."""

    def run(batches):
        vocabulary, held, size = Vocabulary(), {}, 0

        def flushed():
            rows = []
            for lang, parts in held.items():
                words, windows, counts = windows_of(vocabulary, parts)
                for number, a, b in cuts(borders, lang, words, windows):
                    body = Automaton.build(words, windows[a:b], counts[a:b]).dumps()
                    rows.append((number, lang, body))
            for at in range(0, len(rows), 64):
                number, lang, body = zip(*rows[at : at + 64], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), pa.array(lang, pa.string()), pa.array(body, pa.binary())],
                    names=["range", "lang", "body"],
                )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                numbers = vocabulary.numbers(text.as_py())
                held.setdefault(lang, []).append(numbers)
                size += len(numbers)
                if size >= shard_words:
                    yield from flushed()
                    vocabulary, held, size = Vocabulary(), {}, 0
        yield from flushed()

    return texts.mapInArrow(run, "range int, lang string, body binary")


def range_counts(shards: DataFrame, borders: list[tuple], ranges: int, least: int) -> DataFrame:
    """(lang, phrase, f) of what each range holds; a null phrase has all its words.

    Phrases with fewer than ``least`` places in the range are left out, but for the
    beginnings of the range's borders, which other ranges hold too.
    """

    def unite(table: pa.Table) -> pa.Table:
        number, lang = table["range"][0].as_py(), table["lang"][0].as_py()
        words, windows, weights = union([Automaton.loads(b.as_py()) for b in table["body"]])
        ends = [b[1] for b in borders[max(number - 1, 0) : number + 1] if b[0] == lang]
        divided = {end[:k] for end in ends for k in range(1, DEPTH)}
        phrases, counts = [None], [int(weights.sum())]
        for depth, (at, sums) in enumerate(levels(windows, weights), 1):
            frequent = sums >= least
            for i, f in zip(at[frequent].tolist(), sums[frequent].tolist(), strict=True):
                phrases.append(b" ".join(_key(words, windows[i, :depth])))
                counts.append(f)
            rare, keys = at[~frequent], _Keys(words, windows[at[~frequent], :depth])
            for key in sorted(k for k in divided if len(k) == depth):
                j = bisect_left(keys, key)
                if j < len(rare) and keys[j] == key:
                    phrases.append(b" ".join(key))
                    counts.append(int(sums[~frequent][j]))
        return pa.table(
            {
                "lang": pa.array([lang] * len(counts), pa.string()),
                "phrase": pa.array([p if p is None else p.decode() for p in phrases], pa.string()),
                "f": pa.array(counts, pa.int64()),
            }
        )

    return (
        shards.repartition(ranges, "range")
        .groupBy("range", "lang")
        .applyInArrow(unite, "lang string, phrase string, f long")
    )


def phrase_automaton(phrases: list[str], weights: list[int]) -> Automaton:
    """The automaton of distinct phrases; a phrase's weight is that of its path."""
    split = [tuple(p.encode().split(b" ")) for p in phrases]
    words = sorted({w for p in split for w in p})
    label = {w: i for i, w in enumerate(words, 1)}
    windows = np.zeros((len(split), DEPTH), np.int32)
    for i, p in enumerate(split):
        windows[i, : len(p)] = [label[w] for w in p]
    return Automaton.build(words, *sorted_counts(windows, np.array(weights, np.int64)))


def counts_of(asked: list[str], phrases: list[str], counts: list[int]) -> dict[str, int]:
    """The count of each asked phrase, by composition of the two automata.

    A phrase's count is the weight of the arc to its last word, which adds up those of its
    continuations here; so each is put in with what these leave of it.
    """
    exact = dict(zip(phrases, counts, strict=True))
    own = dict(exact)
    for p, f in exact.items():
        head = p.rpartition(" ")[0]
        while head and head not in own:
            head = head.rpartition(" ")[0]
        if head:
            own[head] -= f
    there = phrase_automaton(list(own), list(own.values()))
    here = phrase_automaton(asked, [1] * len(asked))
    wanted, out = set(asked), {}
    for row in here.compose(there).tolist():
        phrase = b" ".join(here.words[i - 1] for i in row[:DEPTH] if i).decode()
        if phrase in wanted and phrase in exact:
            out[phrase] = row[DEPTH]
    return out


def looked_up(asks: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """``asks`` (lang, part, phrase, a, k, side) with the count of each part as ``f``."""

    def bucket() -> Column:
        return F.pmod(F.xxhash64("lang", "part", "salt"), F.lit(buckets)).cast("int")

    dealt = asks.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    copies = counts.select(
        "lang", F.col("phrase").alias("part"), "f",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        found = np.zeros(left.num_rows, np.int64)
        asked_of = np.array(left["lang"].to_pylist(), object)
        known_of = np.array(right["lang"].to_pylist(), object)
        parts = np.array(left["part"].to_pylist(), object)
        known, weights = np.array(right["part"].to_pylist(), object), right["f"].to_numpy()
        for lang in set(asked_of.tolist()):
            mine, theirs = np.flatnonzero(asked_of == lang), np.flatnonzero(known_of == lang)
            f = dict(zip(known[theirs].tolist(), weights[theirs].tolist(), strict=True))
            f = counts_of(sorted(set(parts[mine].tolist())), list(f), list(f.values()))
            found[mine] = [f[p] for p in parts[mine].tolist()]
        return left.select(["lang", "phrase", "a", "k", "side"]).append_column("f", pa.array(found))

    return (
        dealt.withColumn("bucket", bucket())
        .repartition(buckets, "bucket")
        .groupBy("bucket")
        .cogroup(copies.withColumn("bucket", bucket()).repartition(buckets, "bucket").groupBy("bucket"))
        .applyInArrow(find, "lang string, phrase string, a long, k int, side string, f long")
    )


def _words(phrase: str = "phrase") -> Column:
    return F.split(phrase, " ")


def _part(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(_words(), first, size), " ")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    shard_words: int = SHARD_WORDS,
    range_words: int = RANGE_WORDS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` best phrases.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line ends into pieces, these at
    spaces and tabs into words. ``a`` is how often a phrase of 2 to 4 words stands in the
    pieces (``least`` at least), ``l`` and ``r`` how often the two parts of its
    lowest-scoring cut do (ties: the shortest first part), ``n`` counts the language's words.
    Score: floor(2,000,000 * a / (l + r)), exact beyond 64 bits. A phrase inside a longer
    candidate with 80 in 100 of its places or more is left out. Ties in score go by ``a``, then
    by phrase in UTF-8 byte order.

    A null language counts as ``und``, a null text as empty; texts without words and empty
    tables add nothing. Repeated rows count as often as they stand.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
        text_of(text_col).alias("text"),
    )
    seen = texts.agg(F.sum(F.length("text").cast("long")).alias("chars"), F.count("*").alias("n")).first()
    ranges = max(1, -(-(seen["chars"] or 0) // (6 * range_words)))
    borders = []
    if ranges > 1:
        share = min(1.0, BORDER_DOCS / seen["n"])
        sample = (  # drawn by the tasks: none sends more than its share
            texts.where((F.rand(11) < share) & (F.length("text") <= BORDER_CHARS))
            .limit(2 * BORDER_DOCS)
            .collect()
        )
        borders = find_borders([(r["lang"], r["text"]) for r in sample], ranges)
    shards = shard_automata(
        texts.select("lang", F.col("text").cast("binary").alias("text")), borders, shard_words
    )
    partial = written(range_counts(shards, borders, ranges, least), "phrases-ranges")
    sizes = partial.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = written(
        partial.where("phrase IS NOT NULL")
        .groupBy("lang", "phrase")
        .agg(F.sum("f").alias("f"))
        .where(F.col("f") >= least),
        "phrases-counts",
    )
    candidates = counts.withColumn("m", F.size(_words())).where("m > 1")
    return _ranked(_scored(counts, _uncovered(candidates)), sizes, top)


def _uncovered(candidates: DataFrame) -> DataFrame:
    """The candidates (lang, phrase, f, m) that no longer one stands for."""
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("m") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("m") - size + 1), lambda first: _part(first, size)
            ),
        )
    )
    covers = (
        candidates.where("m > 2")
        .select("lang", F.explode(inner).alias("_inner"), F.col("f").alias("_f"))
        .groupBy(F.col("lang").alias("_lang"), "_inner")
        .agg(F.max("_f").alias("_f"))
    )
    covered = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_inner"))
    enough = _exact("_f") * 100 >= _exact("f") * COVERS
    return candidates.join(covers, covered & enough, "left_anti")


def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(28,0)")


def _scored(counts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the lowest-scoring cut."""
    candidates = written(candidates, "phrases-candidates")
    cut = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    )
    asks = cut.select(
        "lang", "phrase", "a", "k",
        F.explode(
            F.array(
                F.struct(F.lit("l").alias("side"), _part(1, F.col("k")).alias("part")),
                F.struct(F.lit("r").alias("side"), _part(F.col("k") + 1, F.col("m")).alias("part")),
            )
        ).alias("_ask"),
    ).select("lang", "phrase", "a", "k", "_ask.side", "_ask.part")
    buckets = max(1, -(-counts.count() * SALTS // LOOKUP_ROWS))
    parts = looked_up(asks, counts, buckets)
    both = parts.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"),
    )
    score = F.expr(
        f"CAST((CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(28,0))) "
        "div (CAST(l AS DECIMAL(28,0)) + CAST(r AS DECIMAL(28,0))) AS LONG)"
    )
    return (
        both.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )


def _ranked(scored: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """Each language's first rows: first of every slice of a language, then of these."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = (
        scored.withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= top).drop("rank")
    )
    return (
        best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        .where(F.col("rank") <= top)
        .join(sizes, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
