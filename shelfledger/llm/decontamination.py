"""Benchmark decontamination by templates: questions are found again under other numbers, names and units.

A text becomes a template: numbers, units and names are replaced by a placeholder of their type, other words are
lower-cased. Whether the first word of a sentence is a name can't be seen from its capital, so a template has two readings:
one in which only capitalised words inside a sentence are names, and one in which first words are names as well. Windows of a
benchmark's templates are joined to those of the documents by hash. Where they meet, the words behind the
placeholders must correspond one to one all along the same alignment, in each reading of the item. A first word that opens
sentences in general, or that the benchmark has in small letters too, stands for itself alone. Items of which no window has enough
other words are looked for word by word. A document that holds half of an item's windows, or a long stretch of them, is
contaminated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import LOWER, PUNCTUATION, frugal, run_hashes, text_slices, word_bounds
from shelfledger.session import stage

WINDOW = 8
#: Words that are not placeholders which a window of a template needs; an item without one is matched word by word.
LEAST_WORDS = 4
#: Share of an item's windows, or windows in all, that make a document contaminated.
COVERAGE = 0.5
LONG = 16
#: Benchmark windows that documents are compared with at a time; more are done in further passes.
BLOCK = 1 << 20
#: Benchmark windows of one hash from which on they are not broadcast.
HOT_WINDOW = 1 << 10
#: The readings of a template: names inside sentences, names anywhere, and the words as they are.
INSIDE, ANYWHERE, EXACT = 0, 1, 2

# Units of measure and money.
UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons
tonne tonnes ounce ounces pound pounds lb lbs oz ml cl dl l liter liters litre litres gallon gallons cup cups
second seconds sec minute minutes min hour hours hr day days week weeks month months year years ms kph mph kmh
cent cents dollar dollars usd euro euros eur gbp yen percent degree degrees celsius fahrenheit kelvin joule joules
watt watts kw kwh volt volts amp amps hz khz mhz ghz byte bytes kb mb gb tb acre acres hectare hectares""".split()

# Words that often open a sentence and are no names.
OPENERS = """a after all also an and are as at because before both but by can could did do does during each either
every few find first for from given has have he her here his how i if in is it its let many more most my next no not now of on
once one only or our she should since so some suppose than that the their then there these they this those three to two under
until we were what when where which while who whom whose why will with would you your
das dann den der die ein eine er es ich im in ist sie was wann warum welche welcher welches wenn wer wie wir wo
ce cette combien comment dans de des elle en est et il la le les lorsque mais nous on ou par pour pourquoi quand que quel quelle
quels qui si son sur un une vous al como con cual cuando cuanto cuantos del donde el ella en eran es esta este la las lo los
para pero por que quien se si su un una y""".split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x51ED270B0A1F2C35, 0x2545F4914F6CDD1D, 0x6C8E9CF570932BD5))
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ENDER = np.zeros(256, bool)
_ENDER[list(b".!?:\n")] = True


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), PUNCTUATION)
    return np.unique(run_hashes(data, starts, ends))


_UNIT_HASHES, _OPENER_HASHES = _hash_words(UNITS), _hash_words(OPENERS)


def template(data: np.ndarray, offsets: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Hashes of the words, the first word of every document, per reading the template's hashes and whether the
    words are placeholders, and which words may be names by the second reading only, and which begin with a small letter."""
    # a point or comma between digits belongs to the number; a changed byte stands for it
    shown = data.copy()
    if len(data) > 2:
        inner = np.flatnonzero(((data[1:-1] == 44) | (data[1:-1] == 46)) & _DIGIT[data[:-2]] & _DIGIT[data[2:]]) + 1
        shown[np.setdiff1d(inner, np.concatenate([offsets, offsets - 1]))] = 48
    starts, ends, first = word_bounds(shown, offsets, PUNCTUATION)
    low = LOWER[data]
    follows = np.concatenate([[False], data[:-1] == 0xC3])
    raised = follows & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    low[raised] += 0x20
    words = run_hashes(low, starts, ends)
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    digits, enders = total(_DIGIT[shown]), total(_ENDER[data])
    capital = ((data >= 65) & (data <= 90)) | np.concatenate([raised[1:], [False]]) if len(data) else np.zeros(0, bool)
    capitals, letters = total(capital), total(~_DIGIT[shown] & (shown < 0x80))
    number = digits[ends] - digits[starts] == ends - starts
    unit = np.isin(words, _UNIT_HASHES)
    opens = np.ones(len(starts), bool)
    opens[1:] = enders[starts[1:]] > enders[ends[:-1]]
    opens[first[:-1][np.diff(first) > 0]] = True
    shouted = capitals[ends] - capitals[starts] > np.maximum(1, (letters[ends] - letters[starts]) // 2)
    name = capital[starts] & ~shouted & (ends - starts > 1) if len(starts) else np.zeros(0, bool)
    readings = []
    for names in (name & ~opens, name):
        typed = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(names, _NAME, words)))
        readings.append((typed, number | unit | names))
    small = LOWER[data] == data
    return words, first, [*readings, (words, np.zeros(len(words), bool))], name & opens, small[starts] & ~number


def windows(reading: int, readings: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, size: int = WINDOW):
    """Windows of a reading: hash, document, first word and end. A text with fewer words is one window. Windows of a
    template with too few words that are not placeholders are left out, and so are those that both readings have in the second."""
    lengths = np.diff(first)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - size + 1, 1))
    doc = np.repeat(np.arange(len(lengths)), counts)
    begin = np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc] + first[doc]
    end = np.minimum(begin + size, first[doc + 1])
    total = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    typed, slots = readings[reading]
    good = np.ones(len(doc), bool)
    if reading != EXACT:
        plain = total(~slots)
        good = plain[end] - plain[begin] >= LEAST_WORDS
    if reading == ANYWHERE:
        other = total(slots != readings[INSIDE][1])
        good &= other[end] > other[begin]
    doc, begin, end = doc[good], begin[good], end[good]
    return run_hashes(typed, begin, end), doc, begin, end


def _rows_of(ids, keys, lo: int, words: np.ndarray, first: np.ndarray, reading: int, slots: np.ndarray, opening: np.ndarray, found) -> pa.RecordBatch:
    hashed, doc, begin, end = found
    values = [words[b:e][slots[b:e]].view(np.int64) for b, e in zip(begin, end)]
    opens = [opening[b:e][slots[b:e]] for b, e in zip(begin, end)]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(lo + doc)), keys.take(pa.array(lo + doc)), pa.array(hashed.view(np.int64)), pa.array(np.full(len(doc), reading, np.int32)),
         pa.array((begin - first[doc]).astype(np.int64)), pa.array((end - begin).astype(np.int64)), pa.array(values, pa.list_(pa.int64())), pa.array(opens, pa.list_(pa.bool_()))],
        ["id", "key", "window", "reading", "at", "words", "slots", "opening"])


def _item_windows(batches):
    """All windows of benchmark items (id, key, text); word by word where an item has no other."""
    for batch in batches:
        ids, keys = batch.column("id"), batch.column("key")
        for lo, _, data, offsets in text_slices(batch.column("text")):
            words, first, readings, opening, _ = template(data, offsets)
            left = np.ones(len(offsets) - 1, bool)
            for reading in (INSIDE, ANYWHERE, EXACT):
                found = windows(reading, readings, first)
                if reading == EXACT:
                    found = tuple(x[left[found[1]]] for x in found)
                left[found[1]] = False
                yield _rows_of(ids, keys, lo, words, first, reading, readings[reading][1], opening, found)


def _wanted_windows(wanted: np.ndarray, sizes: list[tuple[int, int]]):
    """Windows of documents (id, key, text), of these readings and sizes, with a wanted hash."""
    def rows(batches):
        for batch in batches:
            ids, keys = batch.column("id"), batch.column("key")
            for lo, _, data, offsets in text_slices(batch.column("text")):
                words, first, readings, opening, _ = template(data, offsets)
                for reading, size in sizes:
                    found = windows(reading, readings, first, size)
                    if len(found[0]):
                        at = np.minimum(np.searchsorted(wanted, found[0]), len(wanted) - 1)
                        hit = np.flatnonzero(wanted[at] == found[0])
                        yield _rows_of(ids, keys, lo, words, first, reading, readings[reading][1], opening, tuple(x[hit] for x in found))
    return rows


def _small_words(batches):
    """The distinct words of a batch that begin with a small letter, or that open sentences in general."""
    yield pa.RecordBatch.from_arrays([pa.array(_OPENER_HASHES.view(np.int64))], ["word"])
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text")):
            words, *_, small = template(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(words[small]).view(np.int64))], ["word"])


def _with_fixed(items: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The windows of items with ``fixed``: of each placeholder, whether it stands for its own word alone."""
    small = benchmark.mapInArrow(frugal(_small_words), "word long").distinct()
    rows = items.withColumn("row", F.monotonically_increasing_id())
    slots = rows.filter(F.exists("opening", lambda x: x)).select("row", F.posexplode(F.arrays_zip("item_slots", "opening")).alias("place", "slot"))
    told = slots.select("row", "place", F.col("slot.item_slots").alias("word"), F.col("slot.opening").alias("opening")).join(
        small.withColumn("small", F.lit(True)), "word", "left")
    fixed = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(  # a window's placeholders
        "place", (F.col("opening") & F.col("small").isNotNull()).alias("fixed")))).alias("f")).select("row", F.col("f.fixed").alias("fixed"))
    return rows.join(fixed, "row", "left").withColumn(
        "fixed", F.coalesce("fixed", F.transform("item_slots", lambda x: F.lit(False)))).drop("row", "opening")


_ROWS = "id long, key long, window long, reading int, at long, words long, slots array<long>, opening array<boolean>"


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per pair of a document and a benchmark item that it holds: id, key (a hash of the text), item_id,
    coverage (share of the item's windows) and windows (matched, of one consistent alignment each).

    Items with one id count as one text's windows. Null or empty texts, and items without a word, match nothing; shorter items
    than a window are matched by windows of their length; rows that repeat a document's id and text are one; a null id is kept.
    An empty benchmark or table gives no rows; other columns are not read. The benchmark is joined in blocks of
    a fixed number of windows, so what is broadcast doesn't grow with it; windows that very many items share are not
    broadcast but joined by a shuffle.
    """
    spark = docs.sparkSession
    named = lambda df, name: df.select(
        F.col(name).cast("long").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text")
    cut = stage(named(benchmark, "item_id").mapInArrow(frugal(_item_windows), _ROWS).select(
        F.col("id").alias("item_id"), "window", "reading", F.col("at").alias("item_at"), F.col("words").alias("item_words"),
        F.col("slots").alias("item_slots"), "opening"), "benchmark")
    items = stage(_with_fixed(cut, benchmark.select("text")), "benchmark")
    sizes = items.groupBy("item_id").agg(F.countDistinct("item_at").alias("item_windows"))
    # an item shorter than a window is looked for in windows of its own length; at most 3 x WINDOW rows
    asked = sorted((r["reading"], r["item_words"]) for r in items.select("reading", "item_words").distinct().collect())
    hot = items.groupBy("window").count().filter(F.col("count") > HOT_WINDOW).select("window")
    blocks = items.count() // BLOCK + 1
    found = None
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        many = stage(part.join(hot, "window", "left_semi"), "hot")
        for own, few in ((part.join(hot, "window", "left_anti"), True), (many, False)):
            wanted = np.unique(own.select("window").distinct().toArrow().column(0).to_numpy().view(np.uint64))  # about BLOCK at most
            if not len(wanted):
                continue
            seen = named(docs, id_col).mapInArrow(frugal(_wanted_windows(wanted, asked)), _ROWS).drop("reading", "opening")
            met = seen.join(F.broadcast(own) if few else own, "window").filter(~F.exists(
                F.arrays_zip("fixed", "item_slots", "slots"), lambda p: p["fixed"] & (p["item_slots"] != p["slots"])))
            found = met if found is None else found.unionByName(met)
    if found is None:
        return spark.createDataFrame([], "id long, key long, item_id long, coverage double, windows long")
    pairs = F.transform(F.arrays_zip("item_slots", "slots"), lambda p: F.struct(
        p["item_slots"].alias("item"), p["slots"].alias("doc")))
    aligned = found.withColumn("shift", F.col("at") - F.col("item_at")).groupBy(
        "id", "key", "item_id", "shift", "reading").agg(
        F.collect_set("item_at").alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    one_to_one = (F.size("pairs") == F.size(F.array_distinct(F.col("pairs.item")))) & (
        F.size("pairs") == F.size(F.array_distinct(F.col("pairs.doc"))))
    held = aligned.filter(one_to_one).groupBy("id", "key", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("windows"))
    return held.join(sizes, "item_id").withColumn("coverage", F.col("windows") / F.col("item_windows")).filter(
        (F.col("coverage") >= COVERAGE) | (F.col("windows") >= LONG)).select(
        "id", "key", "item_id", "coverage", "windows")


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(
        F.col("id").alias("doc_id"), "item_id", "coverage", "windows")


def stage_decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, unchanged. A null or empty text holds none and stays; each row is judged by its id
    and text, so repeated rows go or stay together, null ids too; an empty table or benchmark takes nothing away; columns
    besides those of documents are not kept."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    held = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("id", "key").distinct()
    keyed = docs.select(columns).withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    return keyed.join(held, keyed["doc_id"].eqNullSafe(held["id"]) & (keyed["key"] == held["key"]), "left_anti").select(columns)
