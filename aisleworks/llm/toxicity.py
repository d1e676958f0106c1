"""Toxicity of texts whose words may be disguised: noisy-channel restoring, then scoring.

A character language model (trigram counts over every document) gives the probability of a word as it was meant; a channel
model gives the cost of writing it in leetspeak, spaced out, with letters repeated or masked.  Viterbi decoding finds
the likeliest reading on the lattice of both.  Only spans that look disguised are decoded; the rest of a text
stays as it is.

The restored text is scored by its words and their beginnings: each has a precision, learned from labelled
documents, and a document is as toxic as its worst word.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisleworks.llm.minhash import mixed, shingles
from aisleworks.llm.shared import only, stored

#: Labelled documents of each class that the fit learns from, those with the smallest hashed doc_id.
PER_CLASS = 10_000
#: How many words and beginnings chance may be expected to put among those that the model keeps.
CHANCE = 0.2
PREFIXES = (4, 5, 6, 7)
#: Documents that the precision of a word's beginning counts for in that of the word; least errors over four folds of the rows
#: to learn from.
SHRINK = 20
#: A beginning counts if it is in this many times as many toxic documents as the commonest word with it.
MANY_WORDS = 1.5
#: Longest span whose reading is remembered; longer ones are decoded each time.
SPAN = 40

# Letters of the language model, and what signs may stand for in leetspeak.
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i", "#": "h", "%": "x",
}
# Letters of other alphabets that look like Latin ones.
ALIKE = dict(zip("аеорсухіѕјкмнтвοαεικνρτυχ", "aeopcyxisjkmhtboaeikvptux"))
_MASKS = "*#"
_JOINTS = ".-_~\u00b7'"
# Channel costs, as natural logarithms: reading a sign as a letter, a mask as a letter, dropping a sign that could be a
# letter, a sign as the gap between words, dropping a joint, a joint as a gap, dropping or keeping the gap between letters
# that stand apart, and a run of one letter as one or two of it.
_LEET_COST, _MASK_COST, _DROP_COST, _GAP_COST = 1.0, 2.0, 14.0, 10.0
_JOINT_DROP, _JOINT_GAP = 3.0, 1.0
_APART_DROP, _APART_GAP = 0.2, 6.0
_RUN_TO_ONE, _RUN_TO_TWO, _PAIR_TO_ONE = 0.3, 0.8, 9.0

SIZE = len(LETTERS) + 1
_CODES = np.zeros(1 << 16, np.uint8)
for _place, _letter in enumerate(LETTERS):
    _CODES[ord(_letter)] = _place + 1
_CODE = {letter: place + 1 for place, letter in enumerate(LETTERS)}

_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
_TWICE = re.compile(r"([^\W\d_])\1")
_LATIN = re.compile(r"[a-z]")
_ALIKE = str.maketrans(ALIKE)
# Anything that ``latin`` could change: neither ASCII nor a letter or sign that it always leaves as it is.
_ODD = re.compile(f"[^\\x00-\\x7f{LETTERS[26:]}\u00a1\u00bf\u00ab\u00bb\u2013\u2014\u2018\u2019\u201c\u201d\u201e]")
_TAIL = re.compile(r"([^\w\s])\1\1+$")
_STANDING_APART = re.compile(r"[^\W_](?:[.\-_*~][^\W_]){3,}")
_HEAD = re.compile(r"^([^\w\s])\1\1+")
_LONG_RUN = re.compile(r"(.)\1{6,}", re.S)
_AROUND = ".,;:!?\"'()[]{}<>\u00ab\u00bb\u2026-_*#/\\|~`"
# Signs around a word that stand for no letter.
_OUTSIDE = "".join(sign for sign in _AROUND if sign not in LEET and sign not in _MASKS)


def letter_triples(text: str) -> np.ndarray:
    """Counts of letter triples of a text as one flat array; 0 stands for anything but a letter."""
    units = np.frombuffer((" " + text.lower() + " ").encode("utf-16-le", "surrogatepass"), np.uint16)
    codes = _CODES[units].astype(np.int32)
    if len(codes) < 3:
        return np.zeros(SIZE**3, np.int64)
    index = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
    # Triples with nothing in the middle say nothing about a word, but one that begins with two gaps.
    return np.bincount(index, minlength=SIZE**3)


def language_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(third | first two) from triple counts, smoothed by pairs and single letters."""
    triple = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    triple[:, 0, 0] = 0
    pair, single = triple.sum(axis=0), triple.sum(axis=(0, 1)) + 1
    p1 = single / single.sum()
    p2 = (pair + 5 * p1) / (pair.sum(axis=1, keepdims=True) + 5)
    p3 = (triple + 5 * p2[None]) / (triple.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


def _lattice(span: str, apart: bool) -> list[list[tuple[str, float]]]:
    """Readings of each place of a span: (letters, cost); '' drops the sign, ' ' ends a word."""
    places: list[list[tuple[str, float]]] = []
    at = 0
    while at < len(span):
        char = span[at]
        end = at
        while end < len(span) and span[end] == char:
            end += 1
        run, at = end - at, end
        if char in _CODE:
            if run == 1:
                places.append([(char, 0.0)])
            elif run == 2:
                places.append([(char * 2, 0.0), (char, _PAIR_TO_ONE)])
            else:
                places.append([(char, _RUN_TO_ONE), (char * 2, _RUN_TO_TWO)])
        elif apart and (char == " " or char in _JOINTS or char in _MASKS and " " not in span):
            places.append([("", _APART_DROP), (" ", _APART_GAP)])
        elif char in _JOINTS:
            places.append([("", _JOINT_DROP), (" ", _JOINT_GAP)])
        else:
            readings = [(letter, _LEET_COST) for letter in LEET.get(char, "")]
            if char in _MASKS:
                readings += [(letter, _MASK_COST) for letter in LETTERS[:26]]
            places += [[*readings, ("", _DROP_COST), (" ", _GAP_COST)]] * min(run, 6)
    return places


def decode(span: str, costs: np.ndarray, apart: bool = False) -> str:
    """The likeliest reading of a span, of any length, by Viterbi decoding over (last two letters)."""
    # A state is the last two codes, 0 standing for a word's edge; it holds its cost and reading, as a chain from the end.
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for readings in [*_lattice(span, apart), [(" ", 0.0)]]:
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, chain) in states.items():
            for letters, extra in readings:
                x, y, total = a, b, cost + extra
                for letter in letters:
                    code = _CODE.get(letter, 0)
                    if code == 0 and y == 0:
                        continue  # an edge after an edge
                    total += costs[x, y, code]
                    x, y = (0, 0) if code == 0 else (y, code)
                known = following.get((x, y))
                if known is None or total < known[0]:
                    following[(x, y)] = (total, (chain, letters) if letters else chain)
        states = following
    (_, chain), read = states[(0, 0)], []  # the last edge leaves no other state
    while chain is not None:
        chain, letters = chain
        read.append(letters)
    return " ".join("".join(reversed(read)).split())


class Restorer:
    """Restores disguised tokens; remembers the readings of tokens seen before, up to a bound."""

    MEMORY = 50_000

    def __init__(self, costs: np.ndarray):
        self.costs = costs
        self.flat = costs.ravel().tolist()
        self.read: dict[str, str | None] = {}

    def _decoded(self, core: str, apart: bool) -> str:
        core = _LONG_RUN.sub(r"\1\1\1\1\1\1", core)  # more of a run reads alike
        if len(core) > SPAN:
            return decode(core, self.costs, apart)
        key = f"{core} {apart}"
        if key not in self.read:
            if len(self.read) >= self.MEMORY:
                self.read.clear()
            self.read[key] = decode(core, self.costs, apart)
        return self.read[key]

    def repeats(self, word: str) -> bool:
        """Whether decoding a word of letters alone can read a repeated letter as fewer.

        A pair is read as one letter if that is likelier with what stands around it; the other letters cost the same
        either way, so three costs decide it without the lattice.  Longer runs are left to the lattice.
        """
        for pair in _TWICE.finditer(word):
            begin, end = pair.span()
            if word[end : end + 1] == word[begin]:
                return True
            before = _CODE.get(word[begin - 1], 0) if begin else 0
            own, after = _CODE.get(word[begin], 0), _CODE.get(word[end], 0) if end < len(word) else 0
            kept = self.flat[(before * SIZE + own) * SIZE + own] + self.flat[(own * SIZE + own) * SIZE + after]
            if own and kept > self.flat[(before * SIZE + own) * SIZE + after] + _PAIR_TO_ONE:
                return True
        return False

    def token(self, token: str) -> str | None:
        """The reading of a lower-case token that looks disguised, else None."""
        if token.isalpha():
            return self._decoded(token, False) if self.repeats(token) else None
        core = _TAIL.sub("", token).strip(_AROUND)
        if len(core) < 3 or core.isdigit() or not _WORD.search(core):
            return None
        if core.isalpha():
            return self._decoded(core, False) if self.repeats(core) else None
        return self._decoded(core, _STANDING_APART.fullmatch(core) is not None)

    def whole(self, token: str) -> str | None:
        """The reading of a lower-case token with the signs at its edges, or of one without letters, where they may be letters.

        ``token`` leaves such tokens as they stand, because most are dates, amounts and exclamations.  Digits alone are a number,
        and three or more of a sign at an edge are ornament.
        """
        if token.isalnum() and _WORD.search(token):
            return None
        core = _HEAD.sub("", _TAIL.sub("", token)).strip(_OUTSIDE)
        if len(core) < 3 or core.isdigit() or core == token.strip(_AROUND) and _WORD.search(core):
            return None
        if not any(sign.isalnum() for sign in core) and not any(sign in LEET for sign in core):
            return None
        return self._decoded(core, False)

    def apart(self, tokens: list[str]) -> Iterator[tuple[int, int, str]]:
        """(begin, end, reading) of each run of three or more single letters, digits or signs that may stand for letters.

        A run of three is one of letters, so that no amount or date is one.
        """
        begin = 0
        while begin < len(tokens):
            end = begin
            while end < len(tokens) and len(tokens[end]) == 1 and (
                tokens[end].isalnum() or tokens[end] in LEET or tokens[end] in _MASKS
            ):
                end += 1
            run = tokens[begin:end]
            if (len(run) >= 4 or len(run) == 3 and "".join(run).isalpha()) and len(set(run)) > 1:
                yield begin, end, self._decoded(" ".join(tokens[begin:end]), True)
            begin = max(end, begin + 1)

    def __call__(self, text: str) -> str:
        """The text in lower case with its disguised tokens restored."""
        lower = text.lower()
        found = list(_TOKEN.finditer(lower))
        tokens = [m[0] for m in found]
        out, at, joined = [], 0, {begin: (end, reading) for begin, end, reading in self.apart(tokens)}
        place = 0
        while place < len(tokens):
            end, reading = joined.get(place, (place + 1, self.token(tokens[place])))
            if reading is not None:
                out += [lower[at : found[place].start()], reading]
                at = found[end - 1].end()
            place = end
        return "".join([*out, lower[at:]])


def features(words: set[str]) -> set[str]:
    """The words and their beginnings; beginnings tell one word (~1) from several different ones (~2).

    >>> sorted(features({"scum", "scummy"}))
    ['scum', 'scummy', 'scummy~1', 'scumm~1', 'scum~2']
    """
    held = Counter(word[:size] for word in words for size in PREFIXES if len(word) >= size)
    return words | {f"{start}~{1 if times == 1 else 2}" for start, times in held.items()}


def latin(token: str) -> str:
    """A token with its compatibility forms, such as wide letters, as plain ones, and look-alikes among Latin letters as those.

    >>> latin("\uff49\uff44\uff49\uff4f\uff54"), latin("idi\u043et"), latin("\u043e\u043d")
    ('idiot', 'idiot', '\u043e\u043d')
    """
    plain = unicodedata.normalize("NFKC", token)
    return plain.translate(_ALIKE) if _LATIN.search(plain) else plain


def document_words(text: str | None, restore: Restorer) -> set[str]:
    """Distinct words of the text as written and as restored."""
    lower = (text or "").lower()
    tokens = lower.split()
    words: set[str] = set()
    if not lower.isascii() and _ODD.search(lower):
        words.update(word for token in set(tokens) if not token.isascii() for word in _WORD.findall(token))
        tokens = " ".join(token if token.isascii() else latin(token) for token in tokens).split()
        lower = " ".join(tokens)
    twice = _TWICE.search(lower) is not None
    for token in set(tokens):
        if token.isalpha():
            words.add(token)
            if not twice:
                continue
        else:
            reading = restore.whole(token)
            if reading is not None:
                words.update(_WORD.findall(reading))
            core = token.strip(_AROUND)
            if core.isalpha():
                words.add(core)
                if not twice:
                    continue
            else:
                words.update(_WORD.findall(token))
        reading = restore.token(token)
        if reading is not None:
            words.update(_WORD.findall(reading))
    for _, _, reading in restore.apart(tokens):
        words.update(_WORD.findall(reading))
    return words


def _triples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(SIZE**3, np.int64)
    for batch in batches:
        held: list[str] = []
        size = 0
        for text in batch["text"]:
            held.append(text)
            size += len(text)
            if size > 500_000:
                counts += letter_triples("\n".join(held))
                held, size = [], 0
        counts += letter_triples("\n".join(held))
    found = np.flatnonzero(counts)
    yield pd.DataFrame({"triple": found, "times": counts[found]})


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may learn from: crc32 of doc_id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def count_triples(docs: DataFrame) -> np.ndarray:
    """Letter triples of every row of ``docs`` (text); at most SIZE ** 3 counts reach the driver."""
    counts = np.zeros(SIZE**3, np.int64)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    held = texts.mapInPandas(_triples, "triple int, times long").groupBy("triple").agg(F.sum("times").alias("times"))
    for row in held.collect():
        counts[row["triple"]] = row["times"]
    return counts


def fit_language(docs: DataFrame) -> np.ndarray:
    """Costs of the character model of ``docs``."""
    return language_costs(count_triples(docs))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sketch(texts: pd.Series) -> pd.Series:
    """The least of four hashes over the three-word shingles of each text."""
    out = []
    for text in texts:
        members = shingles(text, 3)
        out.append([int(mixed(members + np.uint64(k)).min().view(np.int64)) for k in range(4)] if len(members) else [])
    return pd.Series(out, dtype=object)


def _without_copies(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, toxic, text) that share no sketch with a row of smaller doc_id.

    Words of a text that was copied and edited a hundred times would else look as telling as words of
    a hundred texts.
    """
    sketches = texts.select("doc_id", F.posexplode(_sketch(F.coalesce("text", F.lit("")))).alias("place", "least"))
    first = sketches.groupBy("place", "least").agg(F.min("doc_id").alias("first"))
    copies = sketches.join(first, ["place", "least"]).filter("doc_id > first").select("doc_id").distinct()
    return texts.join(copies, "doc_id", "left_anti")


def upper_tail(held: int, toxic: int, clean: int) -> np.ndarray:
    """Chance of k or more toxic documents, k from 0, among ``held`` drawn from ``toxic`` and ``clean`` ones.

    >>> upper_tail(2, 2, 2).round(3).tolist()
    [1.0, 0.833, 0.167]
    """
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, toxic + clean + 1)))])
    k = np.arange(max(0, held - clean), min(held, toxic) + 1)
    of_all = logs[toxic + clean] - logs[held] - logs[toxic + clean - held]
    ways = logs[toxic] - logs[k] - logs[toxic - k] + logs[clean] - logs[held - k] - logs[clean - held + k]
    tail = np.minimum(1.0, np.exp(ways - of_all)[::-1].cumsum()[::-1])
    return np.concatenate([np.ones(k[0]), tail])


def chance_level(held: dict[int, int], toxic: int, clean: int, most: float = CHANCE) -> float:
    """Largest tail probability that at most ``most`` features reach by chance; ``held`` counts features by documents.

    A feature in few documents cannot reach a small probability and takes nothing of the chance that the others have.
    The number of documents moves the level only through what such features can show.

    >>> round(chance_level({2: 1}, 2, 2), 3), chance_level({2: 2}, 2, 2)
    (0.167, 0.0)
    """
    levels, expected = [np.zeros(0)], [np.zeros(0)]
    for documents, features in held.items():
        tail = upper_tail(documents, toxic, clean)
        use = (tail <= most) & (tail > 1e-30)
        levels.append(tail[use])
        expected.append((features * (tail - np.append(tail[1:], 0.0)))[use])
    level, order = np.concatenate(levels), np.argsort(np.concatenate(levels), kind="stable")
    within = level[order][np.concatenate(expected)[order].cumsum() <= most]
    return float(within[-1]) if len(within) else 0.0


def fit_words(docs: DataFrame, labels: DataFrame, costs: np.ndarray) -> tuple[dict[str, float], float]:
    """Precision of each telling word or beginning, and the score of a text that has none.

    Learns from at most ``PER_CLASS`` labelled rows of each class that are not held out.  Words are counted by
    documents in Spark; those that pass the chance level, words of these rows only, reach the driver.  The classes' true
    shares come from all labels that are not held out.
    """
    marked = (
        only(labels, doc_id="long", toxic="int").filter("toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sample = marked.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).unionByName(
        marked.filter("toxic = 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS)
    )
    shares = {row["toxic"]: row["count"] for row in marked.groupBy("toxic").count().collect()}
    shared = docs.sparkSession.sparkContext.broadcast(costs)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restore = Restorer(shared.value)
        for batch in batches:
            found = {0: Counter(), 1: Counter()}
            for toxic, text in zip(batch["toxic"], batch["text"]):
                found[toxic].update(features(document_words(text, restore)) | {""})
            names = found[0].keys() | found[1].keys()
            yield pd.DataFrame(
                [(name, found[1][name], found[0][name]) for name in names], columns=["feature", "toxic", "clean"]
            )

    rows = only(docs, doc_id="long", text="string")
    texts = _without_copies(
        rows.join(sample, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    )
    counts = stored(
        texts.mapInPandas(count, "feature string, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "words",
    )
    total = counts.filter("feature = ''").first()
    if total is None or not total["toxic"] or not total["clean"]:
        return {}, 0.0 if not shares.get(1) else 1.0 if not shares.get(0) else shares[1] / sum(shares.values())
    toxic, clean = total["toxic"], total["clean"]
    odds = shares[1] / shares[0]

    # A beginning that mostly one word has says nothing beyond that word.  Plain words stay out of that join.
    words, starts = (counts.filter(F.col("feature").contains("~") == F.lit(some)) for some in (False, True))
    single = (
        words.filter("toxic > 0")
        .select("toxic", F.explode(F.array(*(F.left("feature", F.lit(n)) for n in PREFIXES))).alias("start"))
        .groupBy("start").agg(F.max("toxic").alias("single"))
    )
    shared_starts = (
        starts.withColumn("start", F.regexp_extract("feature", "^(.*)~[12]$", 1)).join(single, "start")
        .filter(F.col("toxic") >= MANY_WORDS * F.col("single")).select("feature", "toxic", "clean")
    )
    tested = stored(
        words.filter("feature <> ''").unionByName(shared_starts)
        .withColumn("odds", odds * ((F.col("toxic") + 0.1) / toxic) / ((F.col("clean") + 0.1) / clean))
        .select("feature", "toxic", (F.col("toxic") + F.col("clean")).alias("held"), "odds"),
        "tested",
    )
    by_held = {row["held"]: row["count"] for row in tested.groupBy("held").count().collect()}
    level = chance_level(by_held, toxic, clean)
    # How many toxic documents a feature in so many needs; no more rows than there are labelled texts.
    needed = [(held, int(np.argmax(upper_tail(held, toxic, clean) <= level * (1 + 1e-9)))) for held in by_held
              if upper_tail(held, toxic, clean)[-1] <= level * (1 + 1e-9)]
    least = docs.sparkSession.createDataFrame(needed, "held long, least long")
    passing = tested.join(F.broadcast(least), "held").filter("odds >= 0.25 AND toxic >= least").select("feature", "toxic", "held")
    # What is a letter shorter, or seven letters of a word, is in more documents and speaks for the longer one.
    stem, times = F.regexp_extract("feature", "^([^~]*)", 1), F.regexp_extract("feature", "(~[12])?$", 1)
    shorter = F.left(stem, F.least(F.length(stem) - 1, F.lit(PREFIXES[-1])))
    parent = F.when(F.length(shorter) >= PREFIXES[0], F.concat(shorter, F.when(times == "", "~1").otherwise(times)))
    around = counts.select(F.col("feature").alias("parent"), F.col("toxic").alias("p_toxic"), F.col("clean").alias("p_clean"))
    found = passing.withColumn("parent", parent).join(around, "parent", "left").collect()
    each = odds * clean / toxic  # how many toxic documents of the true mix one of the sample stands for

    def precision(with_it: float, without: float, prior: float, weight: float) -> float:
        return (each * with_it + weight * prior) / (each * with_it + without + weight)

    table = {}
    for row in found:
        own = precision(row["toxic"] + 0.1, row["held"] - row["toxic"] + 0.1, 0.0, 0.0)
        if row["p_toxic"] is not None:
            prior = precision(row["p_toxic"] + 0.1, row["p_clean"] + 0.1, 0.0, 0.0)
            own = precision(row["toxic"], row["held"] - row["toxic"], prior, SHRINK)
        table[row["feature"]] = own
    return table, 0.02


def _scorer(docs: DataFrame, costs: np.ndarray, table: dict[str, float], rest: float) -> Callable[[Column], Column]:
    shared = docs.sparkSession.sparkContext.broadcast((costs, table, rest))

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        costs, table, rest = shared.value
        restore = Restorer(costs)
        starts = {feature[:-2] for feature in table if feature[-2:] in ("~1", "~2")}
        told: dict[str, tuple[str, ...]] = {}

        def telling(word: str) -> tuple[str, ...]:
            if len(told) >= 200_000:
                told.clear()
            told[word] = own = tuple(word[:n] for n in PREFIXES if len(word) >= n and word[:n] in starts)
            return own

        def worst(text: str) -> float:
            most, held = rest, []
            for word in document_words(text, restore):
                if word in table:
                    most = max(most, table[word])
                held += told[word] if word in told else telling(word)
            for start, times in Counter(held).items():
                most = max(most, table.get(f"{start}~{1 if times == 1 else 2}", rest))
            return most

        for texts in batches:
            yield pd.Series([worst(text) for text in texts], dtype=float)

    return lambda text: scored(F.coalesce(text.cast("string"), F.lit("")))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    ``labels`` has (doc_id, toxic); only rows that are not held out are learned from, and only the text is scored.
    Texts without a telling word, empty and NULL ones too, get a low score.  Without labels of both classes every
    score is the share of toxic labels.  A row without doc_id is scored and is not held out; repeated rows score
    alike; other columns are ignored; an empty table gives an empty result.
    """
    rows = only(docs, doc_id="long", text="string")
    costs = fit_language(rows)
    table, rest = fit_words(rows, labels, costs)
    scored = rows.withColumn("score", _scorer(rows, costs, table, rest)(F.col("text")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def restored(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with the column restored: the text in lower case with disguised spans as they were meant."""
    shared = docs.sparkSession.sparkContext.broadcast(fit_language(docs))

    @F.pandas_udf(T.StringType())
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restore = Restorer(shared.value)
        for texts in batches:
            yield pd.Series([restore(text) for text in texts], dtype=object)

    return docs.withColumn("restored", F.when(F.col("text").isNotNull(), read(F.coalesce("text", F.lit("")))))
