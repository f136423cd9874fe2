"""Language identification of mixed text.

The script of a word narrows the languages that it may belong to, character
n-grams score it in each of them, and Viterbi with a penalty for each switch
labels spans of words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from showlake.llm.common import in_arrow

UNKNOWN = "und"
#: Documents per language to learn from, n-gram buckets, and lengths of n-grams.
TRAIN_ROWS, BUCKETS, ORDERS = 2000, 1 << 15, (1, 2, 3)
#: Log odds that a switch costs, and the most by which one word may speak against a language.
SWITCH, FLOOR = 12.0, 8.0
#: Share of a language's training letters from which on a script counts as one of its own.
SCRIPT_SHARE = 0.01
#: Scored words that a worker remembers, and documents that are labelled together.
MEMO, BATCH = 300_000, 256
#: Scores of one step from which on texts are stepped through side by side; fewer are faster one by one.
SIDE_BY_SIDE = 24
#: Runs of letters; longer ones, as in scripts without spaces, are cut into chunks that are scored and labelled each.
WORD = re.compile(r"[^\W\d_]{1,64}")
#: What keeps a deviation above zero where all training texts are alike.
TINY = 1e-6
MIX = np.uint64(0x9E3779B97F4A7C15)

#: First and last code points of scripts (Unicode blocks).
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
]


@lru_cache(maxsize=65_536)
def script_of(letter: str) -> str:
    point = ord(letter)
    return next((name for name, first, last in SCRIPTS if first <= point <= last), "other")


def script(word: str) -> str:
    """The script of the first letter in a known range; ``other`` without one."""
    return next((s for s in map(script_of, word) if s != "other"), "other")


def has_letter(word: str) -> bool:
    """Whether it is more than numerals such as superscripts."""
    return word.isalpha() or any(map(str.isalpha, word))


def grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of the n-grams of words with their ends marked, and where each word's begin."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # letters from here to the end of the word
    hashes = np.zeros(len(codes), np.uint64)
    for n in ORDERS:
        ahead = codes[n - 1 :]
        hashes[: len(ahead)] = (hashes[: len(ahead)] + ahead + np.uint64(1)) * MIX
        fits = left >= n
        count = sizes - n + 1
        yield (hashes[fits] >> np.uint64(40)) % np.uint64(BUCKETS), np.cumsum(count) - count


def gram_count(sizes: np.ndarray) -> np.ndarray:
    """How many n-grams words of these sizes have, their ends marked."""
    return sum(sizes + 3 - n for n in ORDERS)


@dataclass
class Model:
    """Log shares of n-gram buckets and the scripts of each language, and the words scored so far."""

    languages: list[str]
    logs: np.ndarray
    scripts: dict[str, np.ndarray]
    switch: float = SWITCH
    #: Of each language's training texts: mean log share of an n-gram, its variance over texts and, per n-gram, over words.
    usual: np.ndarray | None = None
    memo: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    beliefs: np.ndarray | None = None
    shares: np.ndarray | None = None

    def known(self, words: list[str]) -> np.ndarray:
        """The places of the words in the tables of scores and beliefs."""
        new = [w for w in dict.fromkeys(words) if w not in self.memo]
        if new and len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(dict.fromkeys(words))
        if new:
            found = sum(np.add.reduceat(self.logs[buckets], starts, axis=0) for buckets, starts in grams(new))
            self.remember(new, self.score(new, found), found)
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def remember(self, words: list[str], scores: np.ndarray, shares: np.ndarray | None = None) -> None:
        start = len(self.memo)
        blank = np.isnan(scores[:, :1])
        odds = np.exp(scores)
        if self.scores is None or start + len(words) > len(self.scores):
            grown = np.zeros((max(MEMO, start + len(words)), len(self.languages)))
            old = [t[:start] for t in (self.scores, self.beliefs, self.shares) if t is not None]
            self.scores, self.beliefs, self.shares = grown, grown.copy(), grown.copy()
            for table, kept in zip((self.scores, self.beliefs, self.shares), old):
                table[:start] = kept
        rows = slice(start, start + len(words))
        self.scores[rows] = np.where(blank, 0.0, scores)
        self.beliefs[rows] = np.where(blank, 0.0, odds / odds.sum(axis=1, keepdims=True))
        self.shares[rows] = 0.0 if shares is None else shares
        self.memo.update(zip(words, range(start, start + len(words)), strict=True))

    def score(self, words: list[str], found: np.ndarray) -> np.ndarray:
        """Log odds of each word, given its log shares, against its best language, at least -FLOOR; NaN where no language uses the script."""
        none = np.zeros(len(self.languages), bool)
        may = np.array([self.scripts.get(script(w), none) for w in words])
        found = np.where(may, found, -np.inf)
        best = found.max(axis=1, keepdims=True)
        return np.maximum(found - np.where(np.isinf(best), np.nan, best), -FLOOR)

    def path(self, scores: np.ndarray) -> np.ndarray:
        """The best language of each word of one text."""
        return self.paths(scores, np.array([len(scores)]))

    def paths(self, scores: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The best language of each word of texts that lie one behind the other, given a penalty for each switch.

        ``stops`` has the end of each text, none of them empty.  Texts are
        stepped through side by side, a word of each at a time.
        """
        starts = np.append(0, stops[:-1])
        bests = self._bests(scores, starts, stops - starts)
        tops = bests.argmax(axis=0)
        left = [np.flatnonzero(each) for each in bests < bests.max(axis=0) - self.switch]  # words after which it is better to switch
        out = np.empty(len(scores), np.int64)
        for first, end in zip(starts.tolist(), stops.tolist(), strict=True):
            while end > first:
                language = tops[end - 1]
                turn = np.searchsorted(left[language], end - 1) - 1
                begin = max(first, left[language][turn] + 1) if turn >= 0 else first
                out[begin:end] = language
                end = begin
        return out

    def _bests(self, scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each language the score of the best path that ends in it, for each word."""
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        going = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # texts that have a word at this step
        side = int(np.count_nonzero(going * scores.shape[1] >= SIDE_BY_SIDE))
        begins = np.append(0, np.cumsum(going[:side]))
        step = np.repeat(np.arange(side), going[:side])
        places = starts[np.arange(len(step)) - begins[step]] + step
        rows = np.ascontiguousarray(scores[places].T)
        begins = begins.tolist()
        for at, begin, end in zip(begins, begins[1:], begins[2:]):
            before = rows[:, at : at + end - begin]
            rows[:, begin:end] += np.maximum(before, before.max(axis=0) - self.switch)
        out = scores.T.astype(float)
        out[:, places] = rows
        first = max(1, side)
        for start, size in zip(starts.tolist(), sizes.tolist()):
            if size <= first:
                break
            best, rest = out[:, start + first - 1].tolist(), []
            for row in scores[start + first : start + size].tolist():
                switched = max(best) - self.switch
                best = [(b if b >= switched else switched) + s for b, s in zip(best, row)]
                rest.append(best)
            out[:, start + first : start + size] = np.array(rest).T
        return out

    def label(self, batch: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, score, spans) of each text."""
        return [found[:3] for found in self.describe(batch)]

    def describe(self, batch: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]], float]]:
        """(language, score, spans, oddness) of each text.

        One language is the best path as it stands if no run of words gains
        more than half a switch by leaving it, since n runs that leave it take
        n - 1 switches at least; only other texts go through Viterbi, together.
        """
        words = [[w for w in WORD.findall(t.lower()) if w.isalpha() or has_letter(w)] for t in batch]
        flat = [w for ws in words for w in ws]
        if not flat:
            return [(UNKNOWN, 0.0, [], 0.0)] * len(batch)
        places = self.known(flat)
        ends = np.cumsum([len(ws) for ws in words])
        starts = ends - [len(ws) for ws in words]
        full = np.flatnonzero(ends > starts)
        owner = np.repeat(np.arange(len(full)), (ends - starts)[full])
        scores = self.scores[places]
        whole = np.add.reduceat(scores, starts[full], axis=0).argmax(axis=1)
        least = np.zeros(len(full))
        for k in range(len(self.languages)):
            gain = np.cumsum(scores[:, k] - scores[np.arange(len(scores)), whole[owner]])
            before = np.append(0.0, gain[:-1])
            apart = owner * -(np.ptp(gain) + 1e3 + 1.0)
            low = np.minimum.accumulate(before + apart) - apart
            least = np.maximum(least, np.maximum.reduceat(gain - low, starts[full]))
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        best = whole[owner]
        mixed = least > self.switch / 2
        if mixed.any():
            some = mixed[owner]
            best[some] = self.paths(scores[some], np.cumsum((ends - starts)[full][mixed]))
        out: list = [(UNKNOWN, 0.0, [], 0.0)] * len(batch)
        for i in full.tolist():
            a, b = starts[i], ends[i]
            labels = best[a:b]
            weight = np.bincount(labels, sizes[a:b], len(self.languages))
            chosen = int(weight.argmax())
            agree = self.beliefs[places[a:b], chosen] * (labels == chosen)
            score = float((agree * sizes[a:b]).sum() / sizes[a:b].sum())
            odd = self.oddness(places[a:b], sizes[a:b], labels == chosen, chosen)
            out[i] = self.languages[chosen], min(1.0, round(score, 6)), self._spans(batch[i], labels), odd
        return out

    def oddness(self, places: np.ndarray, sizes: np.ndarray, own: np.ndarray, language: int) -> float:
        """By how many deviations the n-grams of a text's own words are rarer than usual in its language; 0 if that was not learned.

        Words in a script that the language does not use take no part.  The
        deviation of a text falls with its length towards that of long texts.
        """
        if self.usual is None:
            return 0.0
        own = own & (self.beliefs[places].sum(axis=1) > 0)
        count = gram_count(sizes[own]).sum()
        mean, over_texts, over_words = self.usual[language]
        if not count or np.isnan(mean):
            return 0.0
        short = mean - self.shares[places[own], language].sum() / count
        return max(0.0, round(float(short / np.sqrt(over_texts + over_words / count + TINY)), 6))

    def _spans(self, text: str, labels: np.ndarray) -> list[tuple[int, int, str]]:
        turns = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
        names = [self.languages[labels[a]] for a in turns[:-1]]
        if len(turns) == 2:
            first, end = 0, len(text)
            while first < end and not text[first].isalpha():
                first += 1
            while end > first and not text[end - 1].isalpha():
                end -= 1
            return [(first, end, names[0])]
        found = [(m.start(), m.end()) for m in WORD.finditer(text) if has_letter(m.group())]
        found += [(len(text), len(text))] * (len(labels) - len(found))  # lower-casing may split a word
        return [(found[a][0], found[b - 1][1], n) for a, b, n in zip(turns[:-1], turns[1:], names, strict=True)]


def held_out() -> Column:
    """Documents that nothing is learned from: crc32 of the doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, rows_per_language: int = TRAIN_ROWS, switch: float = SWITCH, spread: bool = False) -> Model:
    """Learn from about ``rows_per_language`` documents of each language that are not held out and have one.

    The documents are chosen by a hash of their doc_id.  What reaches the
    driver is one row per language and n-gram bucket or script.  With
    ``spread`` the chosen documents are read once more, to learn how usual the
    n-grams of a text in its language are: one row per language.
    """
    chosen = documents.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.col("doc_id").cast("long").alias("doc_id")
    )
    sizes = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)), {}, switch, np.zeros((0, 3)) if spread else None)
    share = F.lit(1.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, rows_per_language / n).otherwise(share)
    chosen = chosen.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            words = Counter((lang, w) for lang, t in zip(batch["lang"], batch["text"], strict=True) for w in WORD.findall(t.lower()))
            groups: dict[tuple[str, str], list[tuple[str, int]]] = {}
            for (lang, word), n in words.items():
                groups.setdefault((lang, script(word)), []).append((word, n))
            for key, found in groups.items():
                tally = seen.setdefault(key, np.zeros(BUCKETS, np.int64))
                times = np.array([n for _, n in found])
                for n, (buckets, _) in zip(ORDERS, grams([w for w, _ in found]), strict=True):
                    each = np.array([len(w) + 3 - n for w, _ in found])
                    np.add.at(tally, buckets.astype(np.int64), np.repeat(times, each))
        for (lang, kind), tally in seen.items():
            at = np.flatnonzero(tally)
            yield pd.DataFrame({"lang": lang, "script": kind, "gram": at.astype(np.int32), "n": tally[at]})

    counted = in_arrow(chosen.select("lang", "text"), count, "lang string, script string, gram int, n long", pandas=True)
    counted = counted.groupBy("lang", "script", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    tallies = np.zeros((BUCKETS, len(languages)))
    at = counted["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(int)
    np.add.at(tallies, (counted["gram"].to_numpy(int), at), counted["n"].to_numpy(float))
    logs = np.log((tallies + 0.1) / (tallies.sum(axis=0) + 0.1 * BUCKETS))
    scripts: dict[str, np.ndarray] = {}
    if len(counted):
        by = counted.groupby(["lang", "script"])["n"].sum()
        for (lang, kind), n in by.items():
            if n >= SCRIPT_SHARE * by[lang].sum():
                scripts.setdefault(kind, np.zeros(len(languages), bool))[languages.index(lang)] = True
    model = Model(languages, logs, scripts, switch)
    if spread:
        model.usual = _spread(chosen, model)
    return model


def _spread(chosen: DataFrame, model: Model) -> np.ndarray:
    """Each language's mean log share of an n-gram, and its variance over texts and, times n-grams, over words; NaN without words."""
    shared = chosen.sparkSession.sparkContext.broadcast((model.languages, model.logs.astype(np.float32), model.scripts))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for batch in batches:
            rows = []
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                words = [w for w in WORD.findall(text.lower()) if has_letter(w)]
                places = own.known(words)
                known = own.beliefs[places].sum(axis=1) > 0 if words else np.zeros(0, bool)
                if not known.any():
                    continue
                found = own.shares[places[known], own.languages.index(lang)]
                sizes = gram_count(np.fromiter(map(len, words), np.int64, len(words))[known])
                level = found.sum() / sizes.sum()
                rows.append((lang, level, ((found - level * sizes) ** 2 / sizes).sum(), len(sizes)))
            yield pd.DataFrame(rows, columns=["lang", "level", "apart", "words"])

    measured = in_arrow(chosen.select("lang", "text"), measure, "lang string, level double, apart double, words long", pandas=True)
    per = measured.groupBy("lang").agg(
        F.avg("level").alias("mean"), F.var_pop("level").alias("texts"), (F.sum("apart") / F.sum("words")).alias("words")
    )
    out = np.full((len(model.languages), 3), np.nan)
    for r in per.collect():
        out[model.languages.index(r["lang"])] = r["mean"], r["texts"], r["words"]
    return out


def identify(documents: DataFrame, model: Model, rows: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every whole text, one row per row.

    ``und`` with score 0 and no spans where the text is null or has no letter,
    or nothing was learned.  ``score`` is the mean belief, weighted by
    letters, in the predicted language over the words labelled with it, other
    words counting as zero; words in a script that no language uses count so
    too.  ``spans`` are character offsets (end exclusive) with a language.
    Equal weights go to the first language by name.  Only doc_id and text are
    read; with ``rows`` a column ``row`` carries all columns along, whatever
    their names, so that a filter needs no join.  A model trained with ``spread``
    adds ``oddness``: by how many deviations the n-grams of the words labelled
    with the predicted language are rarer than in its training texts, at least
    0, and 0 for ``und``; it tells languages that were not learned.
    """
    spark = documents.sparkSession
    given = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(*(F.col(f"`{c}`") for c in (documents.columns if rows else ["text"]))).alias("row"),
    )
    if not model.languages:
        empty = F.array().cast("array<struct<start:int,end:int,lang:string>>")
        odd = [] if model.usual is None else [F.lit(0.0).alias("oddness")]
        labelled = given.select(
            "*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), empty.alias("spans"), *odd
        )
        return labelled if rows else labelled.drop("row")
    shared = spark.sparkContext.broadcast((model.languages, model.logs.astype(np.float32), model.scripts, model.switch, model.usual))
    with_oddness = model.usual is not None

    place = documents.columns.index("text") if rows else 0
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                part = whole.slice(at, BATCH)
                got = own.describe([t or "" for t in part.column(1).field(place).to_pylist()])
                spans = [[dict(zip(("start", "end", "lang"), x, strict=True)) for x in g[2]] for g in got]
                columns = [pa.array([g[0] for g in got]), pa.array([g[1] for g in got]), pa.array(spans, pa.list_(span))]
                carried = part.columns if rows else part.columns[:1]
                names = part.schema.names[: len(carried)] + ["lang_pred", "score", "spans"]
                if with_oddness:
                    columns, names = [*columns, pa.array([g[3] for g in got])], [*names, "oddness"]
                yield pa.RecordBatch.from_arrays([*carried, *columns], names)

    schema = given.schema if rows else T.StructType(given.schema.fields[:1])
    schema = T.StructType([*schema.fields]).add("lang_pred", "string").add("score", "double")
    schema = schema.add("spans", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("lang", "string")))
    if with_oddness:
        schema = schema.add("oddness", "double")
    return in_arrow(given, run, schema)
