"""Benchmark decontamination by templates: finds benchmark questions in documents, also with other parameters.

A text is read twice, as sequences of template tokens. Both readings put typed placeholders for numbers and units;
reading ``NAMED`` puts one for every capitalised word too, wherever it stands (neighbours are one name), reading
``PLAIN`` takes words as they are in lower case. So other names match in the first reading, and other capitals,
a lost full stop or a question inside a sentence in the second; no list of names is needed. Sentence ends are no tokens.

Every window of ``window`` tokens is hashed (an item shorter than that is one window of its own length); windows of
documents and of benchmark items are joined on reading, length and hash. Where a document holds a window of an item,
the values in its slots are compared: along one placement of the item (same distance between positions) an item's
value must stand for one value of the document. So a question whose 3 apples became 7 throughout is found, and
chance matches of bare templates are not. A document is contaminated by an item when consistent placements cover
``share`` of the item's windows in one of the readings.

A unit is a word of ``UNITS`` after a number, or a sign of currency or per cent. A window needs ``literals`` plain
words, so that no window is all placeholders. An item that has no such window in either reading is read a third way,
``EXACT``: its windows hold the values themselves, and a document must hold all of them. Such an item needs
``shortest`` tokens.

Documents send on only the windows whose hash is in a filter of the benchmark's (a Bloom filter of 16 bits a window,
at most ``MOST_BITS``; false positives go in the join, so a larger benchmark costs more and finds the same), so a
passage that a third of all documents share is shuffled only where the benchmark holds it. The benchmark itself is
never broadcast by us.

Defined results: null and empty texts have no windows; nor have items of fewer than ``shortest`` tokens. Repeated
item ids pool their windows, repeated doc_ids theirs; null ids match nothing. Columns of other names stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized

TOKENS = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[.!?\n%$€£]")
#: The same for texts of ASCII characters.
PLAIN_TOKENS = re.compile(r"[A-Za-z]+(?:['-][A-Za-z]+)*|[0-9]+(?:[.,:/][0-9]+)*|[.!?\n%$]")
REMEMBERED = 500_000
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: Characters of texts that are worked on at once.
CHUNK = 1 << 18

# Words that are numbers, and units after numbers.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen "
    "half quarter".split()
)
UNITS = frozenset(
    "mm cm dm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons pound pounds ounce "
    "ounces ml cl l liter liters litre litres gallon gallons cup cups s sec secs second seconds min mins minute "
    "minutes h hr hrs hour hours day days week weeks month months year years mph kph kmh cent cents dollar dollars "
    "euro euros percent degree degrees".split()
)
WORD, NUMBER, UNIT, NAME, END = range(5)
NAMED, PLAIN, EXACT = range(3)


@dataclass(frozen=True)
class Settings:
    window: int = 8
    literals: int = 4
    share: float = 0.3
    agree: float = 0.85
    shortest: int = 3


def kind_of(token: str) -> int:
    """What a token is by itself; UNIT only after a number, NAME only in reading NAMED."""
    if token in ".!?\n":  # and the empty one between two texts
        return END
    if token[0].isdigit():
        return NUMBER
    if token in "%$€£":
        return UNIT
    lower = token.lower()
    if lower in NUMBERS:
        return NUMBER
    if token[0].isupper() and not token.isupper():
        return NAME
    return UNIT if lower in UNITS else WORD


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


_PLACE = np.asarray([_hash(f"\0{k}") for k in range(5)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Template:
    """Texts in one reading: of each template token its hash, whether it is a placeholder and its text's number; of
    each text its first template token; and the first token of the batch each one spans, with their end."""

    hashes: np.ndarray
    slots: np.ndarray
    text: np.ndarray
    first: np.ndarray
    spans: np.ndarray


class Canon:
    """Texts to template tokens; what a token is, is worked out once per distinct token."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}
        self.kinds, self.hashes = np.zeros(1 << 10, np.int8), np.zeros(1 << 10, np.uint64)

    def _codes(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for token in set(tokens).difference(known):
                at = len(known)
                if at == len(self.kinds):
                    self.kinds, self.hashes = np.resize(self.kinds, 2 * at), np.resize(self.hashes, 2 * at)
                known[token] = at
                self.kinds[at], self.hashes[at] = kind_of(token), _hash(token.lower())
            return np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens))

    def templates(self, texts: list[str], readings: set[int]) -> tuple[list[str], dict[int, Template]]:
        """All tokens of the texts, an empty one after each text, and these readings of them."""
        tokens: list[str] = []
        ends = []
        for text in texts:
            tokens += (PLAIN_TOKENS if text.isascii() else TOKENS).findall(text)
            tokens.append("")
            ends.append(len(tokens))
        codes = self._codes(tokens)
        kinds, hashes = self.kinds[codes], self.hashes[codes]
        of_text = np.repeat(np.arange(len(texts)), np.diff([0, *ends]))
        before = np.concatenate([[END], kinds[:-1]])
        lone = (kinds == UNIT) & (before != NUMBER)
        signs = [self.known[x] for x in "%$€£" if x in self.known]
        for sign in signs:
            lone &= codes != sign
        kinds = np.where(lone, WORD, kinds)
        again = (kinds == NAME) & (np.concatenate([[END], kinds[:-1]]) == NAME)
        words = kinds != END

        def reading(keep: np.ndarray, slot: np.ndarray | None) -> Template:
            (at,) = np.nonzero(keep)
            own, seen = of_text[at], hashes[at]
            slot = np.zeros(len(at), bool) if slot is None else slot[at]
            seen[slot] = _PLACE[kinds[at[slot]]]
            first = np.searchsorted(own, np.arange(len(texts)))
            return Template(seen, slot, own, first, np.append(at, len(tokens)))

        ways = {
            NAMED: lambda: reading(words & ~again, kinds != WORD),
            PLAIN: lambda: reading(words, (kinds == NUMBER) | (kinds == UNIT)),
            EXACT: lambda: reading(words, None),
        }
        return tokens, {r: ways[r]() for r in sorted(readings)}


@cache
def canon() -> Canon:
    """One per Python worker, which serves task after task."""
    return Canon()


class _Powers:
    """Powers of the odd multiplier and of its inverse modulo 2**64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            back = np.uint64(pow(int(_MIX), -1, 1 << 64))
            self.up, self.down = (np.cumprod(np.append(np.uint64(1), np.full(2 * n, x, np.uint64))) for x in (_MIX, back))
        return self.up, self.down


_POWERS = _Powers()


def running_hashes(template: Template) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of a window of any length is one difference; and the number of plain words so far."""
    _, down = _POWERS.get(len(template.hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(template.hashes * down[: len(template.hashes)], dtype=np.uint64)])
    return sums, np.concatenate([[0], np.cumsum(~template.slots)])


def window_hashes(template: Template, running: tuple, reading: int, n: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of the windows of n tokens within one text that have enough plain words."""
    count = len(template.hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums, plain = running
    (at,) = np.nonzero((plain[n:] - plain[:count] >= literals) & (template.text[n - 1 :] == template.text[:count]))
    up, _ = _POWERS.get(len(sums))
    total = (sums[at + n] - sums[at]) * up[at + n - 1] + np.uint64((3 * n + reading) * int(_MIX) % (1 << 64))
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return at, total ^ (total >> np.uint64(32))


def _filter_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _passing(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each hash is in the filter, whose bits are 32 to a word."""
    hit = np.ones(len(hashes), bool)
    for place in _filter_places(hashes, 32 * len(words)):
        hit &= ((words[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1)).view(bool)[::4]
    return hit


def _chunks(batch: pd.DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts, of about CHUNK characters or one text, without the rows that have none."""
    keys, texts, size = [], [], 0
    for own, text in zip(batch["key"], batch["text"], strict=True):
        if isinstance(text, str):
            keys.append(own)
            texts.append(text)
            size += len(text)
        if size >= CHUNK:
            yield keys, texts
            keys, texts, size = [], [], 0
    if texts:
        yield keys, texts


COLUMNS = ["key", "reading", "size", "at", "hash", "values", "spots"]
SCHEMA = "key long, reading int, size int, at int, hash long, values array<string>, spots array<int>"


def _rows(key: list, tokens: list[str], template: Template, reading: int, n: int, at: np.ndarray, found: np.ndarray) -> list[tuple]:
    out = []
    for i, h in zip(at.tolist(), found.view(np.int64).tolist(), strict=True):
        (some,) = np.nonzero(template.slots[i : i + n])
        values = [" ".join(x for x in tokens[slice(*template.spans[i + j : i + j + 2])] if x not in ".!?\n").lower() for j in some]
        place = i - int(template.first[template.text[i]])
        out.append((key[template.text[i]], reading, n, place, h, values, (place + some).tolist()))
    return out


def windows(texts: DataFrame, key: str, settings: Settings, sizes: list[tuple[int, int]], bloom) -> DataFrame:
    """key, reading, size, at, hash, values of the slots and their spots in the text, of the windows that pass
    ``bloom``. ``sizes``: pairs of a reading and a length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, some in _chunks(batch):
                tokens, templates = canon().templates(some, {r for r, _ in sizes})
                running = {r: running_hashes(templates[r]) for r, _ in sizes}
                rows = []
                for r, n in sizes:
                    at, found = window_hashes(templates[r], running[r], r, n, 0 if r == EXACT else min(settings.literals, n))
                    hit = _passing(found, bloom.value)
                    rows += _rows(keys, tokens, templates[r], r, n, at[hit], found[hit])
                yield pd.DataFrame(rows, columns=COLUMNS)

    named = texts.select(F.col(key).cast("long").alias("key"), "text").filter("key is not null")
    return named.mapInPandas(run, SCHEMA).withColumnRenamed("key", key)


def item_windows(items: DataFrame, settings: Settings) -> DataFrame:
    """The same for every window of the benchmark's items, of ``window`` tokens or of a shorter item's own length."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for keys, some in _chunks(batch):
                for own, text in zip(keys, some, strict=True):
                    tokens, templates = canon().templates([text], {NAMED, PLAIN, EXACT})
                    found = []
                    for r, template in templates.items():
                        n = min(settings.window, len(template.hashes))
                        if n < (settings.shortest if r == EXACT else min(settings.literals, settings.window)) or (r == EXACT and found):
                            continue
                        least = 0 if r == EXACT else min(settings.literals, n)
                        found += _rows([own], tokens, template, r, n, *window_hashes(template, running_hashes(template), r, n, least))
                    rows += found
            yield pd.DataFrame(rows, columns=COLUMNS)

    named = items.select(F.col("item_id").cast("long").alias("key"), "text").filter("key is not null")
    return named.mapInPandas(run, SCHEMA).withColumnRenamed("key", "item_id")


def filter_of(hashes: DataFrame, count: int) -> np.ndarray:
    """The Bloom filter of a column ``hash`` of ``count`` rows: words of bits set by tasks and joined by Spark."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * count).bit_length()))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(np.concatenate(_filter_places(batch["hash"].to_numpy(np.int64).view(np.uint64), bits)))
            yield pd.DataFrame({"word": at >> 5, "bits": np.left_shift(1, at & 31)})

    words = hashes.select("hash").mapInPandas(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(bits // 32, np.uint32)
    found = words.toPandas()  # at most MOST_BITS / 32 rows
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, matched, item_windows, share, slots, kind (``verbatim`` where all slots are as in the
    item, else ``reparameterised``) of each contaminated pair."""
    items = materialized(item_windows(benchmark, settings))
    read = items.groupBy("reading", "size").count().collect()  # at most three readings of ``window`` lengths
    sizes = sorted((r["reading"], r["size"]) for r in read)
    bloom = docs.sparkSession.sparkContext.broadcast(filter_of(items, sum(r["count"] for r in read)))
    found = windows(docs, "doc_id", settings, sizes, bloom)
    of_items = items.select(
        "item_id",
        "reading",
        "size",
        "hash",
        F.col("at").alias("item_at"),
        F.col("values").alias("item_values"),
        F.col("spots").alias("item_spots"),
    )
    hits = materialized(
        found.join(of_items, ["reading", "size", "hash"])
        .withColumn("shift", F.col("at") - F.col("item_at"))
        .filter(F.size("values") == F.size("item_values"))
        .select("doc_id", "item_id", "reading", "shift", "item_at", F.arrays_zip("item_spots", "item_values", "values").alias("slots"))
    )
    place = ["doc_id", "item_id", "reading", "shift"]
    # A slot counts once, however many windows hold it.
    pairs = hits.select(*place, F.explode("slots").alias("s")).select(
        *place, F.col("s.item_spots").alias("spot"), F.col("s.item_values").alias("was"), F.col("s.values").alias("now")
    )
    pairs = pairs.distinct()
    meant = pairs.groupBy(*place, "was", "now").agg(F.count(F.lit(1)).alias("n")).groupBy(*place, "was").agg(
        F.max("n").alias("most"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("was") == F.col("now"), F.col("n")).otherwise(0)).alias("same"),
    )
    checked = meant.groupBy(*place).agg(F.sum("most").alias("most"), F.sum("n").alias("n"), F.sum("same").alias("same"))
    per_place = hits.groupBy(*place).agg(F.collect_set("item_at").alias("ats"))  # at most the item's windows
    good = per_place.join(checked, place, "left").filter(F.col("n").isNull() | (F.col("most") >= settings.agree * F.col("n")))
    covered = (
        good.withColumn("item_at", F.explode("ats"))
        .groupBy("doc_id", "item_id", "reading", "item_at")
        .agg(F.min(F.coalesce("n", F.lit(0)) - F.coalesce("same", F.lit(0))).alias("changed"), F.max(F.coalesce("n", F.lit(0))).alias("n"))
        .groupBy("doc_id", "item_id", "reading")
        .agg(F.count(F.lit(1)).alias("matched"), F.max("changed").alias("changed"), F.max("n").alias("slots"))
    )
    sizes_of = items.groupBy("item_id", "reading").agg(F.countDistinct("at", "size").alias("item_windows"))
    enough = covered.join(sizes_of, ["item_id", "reading"]).withColumn("share", F.col("matched") / F.col("item_windows"))
    enough = enough.filter(F.col("share") >= F.when(F.col("reading") == EXACT, 1.0).otherwise(settings.share))
    # Of several readings the one that covers most; then the one with the fewest changes.
    best = F.max_by(
        F.struct("matched", "item_windows", "share", "slots", "changed"), F.struct("share", -F.col("changed"), -F.col("reading"))
    )
    return (
        enough.groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "item_id",
            "best.matched",
            "best.item_windows",
            "best.share",
            "best.slots",
            F.when(F.col("best.changed") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
        )
    )
