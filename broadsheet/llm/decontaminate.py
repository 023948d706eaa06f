"""Benchmark decontamination by template canonicalisation.

Numbers, names and units of measure are marked, then read as typed placeholders: a question
and its copy with other figures and names have the same template. Windows of template words
are hash-joined. What stands in the slots must agree up to renaming: slots that are equal in
the benchmark's window are equal in the document's and the other way round. Column functions only.

A benchmark window of few literal words is widened until it holds enough, to the whole item at most,
and is also looked up word for word as it is, so that no item is left without a window. A capital that
may only begin a sentence is read in two ways, as the word and as a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.binding import computed
from broadsheet.llm.common import row_key, shared_parts, shared_table, text_of

WINDOW = 8
# Windows of fewer literal words say too little under other figures; they are widened, and matched exactly.
LITERALS = 5
# Windows of up to so many words are hashed one by one; wider ones from names of 1, 2, 4 .. words.
DIRECT = 16
# Benchmark windows up to this number are broadcast (about 200 bytes each); more are joined by shuffling.
BROADCAST_WINDOWS = 200_000

UNITS = (
    "km cm mm kg mg ml km/h mph m g l s h min hours hour minutes minute seconds second days day years year "
    "euros euro dollars dollar percent"
).split()

_NUMBER, _NAME, _UNIT, _LITERAL = "\x01", "\x02", "\x03", "\x04"
# Leads a word with a capital of which the place does not tell whether it is a name; above the other marks.
_MAYBE, _PLAIN = "\x04", "\x05"
# A capital inside a sentence begins a name; groups only, so that every engine reads them alike.
NAME_PATTERN = r"([\p{Ll},;:] )(\p{Lu})"
UNIT_PATTERN = r"([0-9] ?)(" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")([^\p{L}\p{N}]|$)"
POINT_PATTERN = r"([0-9])[.,]([0-9])"
NUMBER_PATTERN = r"[0-9]+(_[0-9]+)*"
WORD_PATTERN = r"[\p{L}\p{N}_\x01-\x03]+"
MAYBE_PATTERN = r"(?<![\p{L}\p{N}_\x01-\x03])(\p{Lu})"
MARKED_WORD_PATTERN = r"[\p{L}\p{N}_\x01-\x04]+"


def with_words(df: DataFrame) -> DataFrame:
    """Replaces ``text`` by ``words``, in lower case; a leading control character marks
    numbers, names, units and words that may be names. Every step is evaluated once a row."""
    text = F.col("text")
    marks = F.lit(False)
    for mark in (_NUMBER, _NAME, _UNIT, _MAYBE):
        marks = marks | text.contains(mark)
    plain = F.when(marks, F.translate(text, _NUMBER + _NAME + _UNIT + _MAYBE, "   " + _PLAIN)).otherwise(text)
    named = F.regexp_replace(F.regexp_replace(plain, NAME_PATTERN, "$1" + _NAME + "$2"), MAYBE_PATTERN, _MAYBE + "$1")
    df = computed(df, named.alias("named")).drop("text")
    figures = F.regexp_replace("named", UNIT_PATTERN, "$1 " + _UNIT + "$2$3")
    figures = F.regexp_replace(figures, POINT_PATTERN, "$1_$2")
    figures = F.regexp_replace(figures, NUMBER_PATTERN, _NUMBER + "$0")
    marked = F.when(F.col("named").rlike("[0-9]"), figures).otherwise(F.col("named"))
    words = F.regexp_extract_all(F.lower(marked), F.lit(MARKED_WORD_PATTERN), F.lit(0))
    return computed(df, words.alias("words")).drop("named")


# Readings of a word by its mark: words that may be names as words, or as names; and as it is written.
def _as_words(w: Column) -> Column:
    return F.when(w < _LITERAL, F.substring(w, 1, 1)).when(w < _PLAIN, F.substring(w, 2, 1 << 30)).otherwise(w)


def _as_names(w: Column) -> Column:
    return F.when(w < _LITERAL, F.substring(w, 1, 1)).when(w < _PLAIN, F.lit(_NAME)).otherwise(w)


def _as_written(w: Column) -> Column:
    return F.translate(w, _NAME + _MAYBE, "")


_READINGS = {"words": (_as_words, _LITERAL), "names": (_as_names, _PLAIN)}


def _slots(words: Column, below: str = _PLAIN) -> Column:
    """``(at, value)`` of the marked words; one that may be a name has the value of the name."""
    value = lambda w: F.when(w >= _MAYBE, F.translate(w, _MAYBE, _NAME)).otherwise(w)
    placed = F.transform(words, lambda w, i: F.when(w < below, F.struct(i.alias("at"), value(w).alias("value"))))
    return F.filter(placed, lambda s: s.isNotNull())


def _named(read):
    return lambda w: F.xxhash64(read(w))


def _marks(df: DataFrame, *readings) -> DataFrame:
    """Adds ``m0``, ``m1``, ..: the words' hashes in each reading."""
    return computed(df, *[F.transform("words", _named(read)).alias(f"m{i}") for i, read in enumerate(readings)])


def _hash_at(marks: str, pos: str, window: int) -> Column:
    """The hash of the ``window`` words from ``pos`` on, for windows of up to ``DIRECT`` words."""
    return F.xxhash64(*[F.get(marks, F.col(pos) + k) for k in range(window)])


def _hashed(df: DataFrame, window: int, *readings) -> DataFrame:
    """Adds ``hashes``, by place the distinct hashes of the window of ``words`` in each reading."""
    df = _marks(df, *readings)
    # names of 1, 2, 4 .. words from each word on; two that overlap name a window of any size
    width = 1
    while width < window:
        step = min(width, window - width)
        names = [
            F.zip_with(f"m{i}", F.slice(f"m{i}", step + 1, F.size(f"m{i}")), lambda a, b: F.xxhash64(a, b)).alias(f"n{i}")
            for i in range(len(readings))
        ]
        df = computed(df, *names).drop(*[f"m{i}" for i in range(len(readings))])
        df = df.withColumnsRenamed({f"n{i}": f"m{i}" for i in range(len(readings))})
        width += step
    if len(readings) == 1:
        both = F.transform("m0", lambda a: F.array(a))
    else:
        both = F.zip_with("m0", "m1", lambda a, b: F.when(a == b, F.array(a)).otherwise(F.array(a, b)))
    return df.select("*", both.alias("hashes")).drop(*[f"m{i}" for i in range(len(readings))])


def _windows(df: DataFrame, window: int, readings, *kept: str) -> DataFrame:
    """``kept``, ``pos`` (from 0) and ``hash`` for every window of ``words`` in each reading;
    readings that agree count once."""
    df = df.filter(F.size("words") >= window).select(*kept, "words", F.size("words").alias("n_words"))
    if window <= DIRECT:
        # a window's hash is computed in its row, by generated code: no lambda for every word
        df = _marks(df, *readings).select(*kept, "n_words", *[f"m{i}" for i in range(len(readings))])
        starts = F.sequence(F.lit(0), F.col("n_words") - window)
        spread = df.select("*", F.explode(starts).alias("pos"))
        hashes = [_hash_at(f"m{i}", "pos", window).alias(f"h{i}") for i in range(len(readings))]
        spread = spread.select(*kept, "pos", *hashes)
        if len(readings) == 1:
            return spread.withColumnRenamed("h0", "hash")
        of = F.when(F.col("h0") == F.col("h1"), F.array("h0")).otherwise(F.array("h0", "h1"))
        return spread.select(*kept, "pos", F.explode(of).alias("hash"))
    df = _hashed(df, window, *readings).drop("words")
    spread = df.select(*kept, "n_words", F.posexplode("hashes").alias("pos", "of"))
    spread = spread.filter(F.col("pos") <= F.col("n_words") - window)
    return spread.select(*kept, "pos", F.explode("of").alias("hash"))


def _wanted(items: DataFrame, window: int, literals: int) -> DataFrame:
    """``(item_id, words, reading, base, base_pos, pos, size)``: for every window of the benchmark
    the one that holds enough literals, itself or wider; ``size`` is null if the item has too few."""
    n = F.size("words")
    both = None
    for reading, (_, below) in _READINGS.items():
        said = F.array_except(F.sequence(F.lit(0), n - 1), F.transform(_slots(F.col("words"), below), lambda s: s.at))
        one = items.filter(n > 0).select("item_id", "words", F.lit(reading).alias("reading"), said.alias("said"))
        both = one if both is None else both.unionByName(one)
    both = both.withColumn("base", F.least(n, F.lit(window)))
    both = both.select("*", F.explode(F.sequence(F.lit(0), n - F.col("base"))).alias("base_pos"))
    before = F.size(F.filter("said", lambda i: i < F.col("base_pos")))
    last = F.get("said", before + literals - 1) if literals else F.col("base_pos")
    start = F.get("said", F.size("said") - literals)
    both = both.withColumns({"last": last, "start": start})
    pos = F.when(F.col("last").isNotNull(), F.col("base_pos")).otherwise(F.col("start"))
    size = F.when(F.col("last").isNotNull(), F.greatest("base", F.col("last") - F.col("base_pos") + 1)).otherwise(n - F.col("start"))
    return both.select("item_id", "words", "reading", "base", "base_pos", pos.alias("pos"), size.alias("size"))


def _of_size(wanted: DataFrame, size: int, readings: dict) -> DataFrame:
    """``wanted(item_id, words, reading, pos)`` with the ``hash`` and the ``slots`` of the window
    of ``size`` words; a window without figures is one that is looked up as written."""
    parts = []
    for reading, (read, below) in readings.items():
        own = wanted.filter(F.col("reading") == reading)
        if size <= DIRECT:
            own, of = _marks(own, read), _hash_at("m0", "pos", size)
        else:
            own, of = _hashed(own, size, read), F.get(F.get("hashes", "pos"), F.lit(0))
        inside = F.filter(_slots(F.col("words"), below), lambda s: (s.at >= F.col("pos")) & (s.at < F.col("pos") + size))
        parts.append(own.select("item_id", "reading", of.alias("hash"), F.col("pos").alias("item_pos"), inside.alias("slots")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.distinct()


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_WINDOWS else df


def template_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS
) -> DataFrame:
    """``(doc_id, key1, key2, item_id, n_windows, first_word, n_changed)`` for documents that
    share a template window with a benchmark item, slots consistent.

    ``n_windows`` counts matching pairs of windows, ``n_changed`` those whose slots hold other
    values than the benchmark's, ``first_word`` is the first matching word's place. Items of
    fewer words than ``window`` are matched whole. A window of fewer than ``literals`` literal
    words is widened, and matched as written too. Such windows, and those that match only where a
    word that begins a sentence is read as a name, are counted for pairs that share no other.
    ``key1`` and ``key2`` name the row by id and text (``common.row_key``); repeated rows count as one. Null and empty texts have no windows.
    An empty table on either side gives an empty table.
    """
    items = with_words(benchmark.select("item_id", text_of().alias("text")))
    wanted = shared_table(_wanted(items, window, literals), "wanted_windows")
    texts = docs.select("doc_id", *row_key(), text_of().alias("text"))
    words = with_words(texts)
    who = ["doc_id", "key1", "key2"]
    reads = [r[0] for r in _READINGS.values()]
    few = wanted.filter("size is null or size > base")
    place = ["key1", "key2", "item_id", "size", "reading", "pos", "item_pos"]

    def sizes(of: DataFrame, column: str) -> list[int]:
        return [r[0] for r in of.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).collect()]

    def meet(words, size, readings, sought):
        sought = shared_table(sought, "sought_windows")
        found = _windows(words, size, readings, *who).join(_small(sought), "hash").drop("hash")
        # of a document that may hold a wider window only the name is needed
        found = found.withColumns({"size": F.lit(size), "pos": F.expr("case when item_pos is not null then pos end")})
        return found.dropDuplicates(place)

    # windows of each size are met in a job of their own: no plan grows with the number of sizes
    def narrow():
        for size in sizes(wanted, "base") or [window]:
            whole = _of_size(wanted.filter((F.col("base") == size) & (F.col("size") == size)), size, _READINGS)
            seeds = _of_size(few.filter(F.col("base") == size).withColumn("pos", F.col("base_pos")), size, _READINGS)
            seeds = seeds.select("hash").distinct()
            yield meet(words, size, reads, whole.unionByName(seeds, allowMissingColumns=True))

    def wider(near):
        for size in sizes(few, "size"):
            yield meet(near, size, reads, _of_size(few.filter(F.col("size") == size), size, _READINGS))
        for size in sizes(few, "base"):
            exact = few.filter(F.col("base") == size).withColumns({"pos": F.col("base_pos"), "reading": F.lit("written")})
            yield meet(near, size, [_as_written], _of_size(exact, size, {"written": (_as_written, "")}))

    met = shared_parts(narrow(), "template_windows")
    near = met.filter("item_pos is null").select("key1", "key2").distinct()
    met = met.filter("item_pos is not null")
    if not near.isEmpty():
        # windows of few literals: wider ones, and as written, in the documents that hold their template
        near = with_words(shared_table(texts.join(_small(near), ["key1", "key2"], "left_semi"), "likely_documents"))
        met = met.unionByName(shared_parts(wider(near), "wider_windows"))
    # what stands in the slots, read again from the few documents that matched
    theirs = met.select(*place, F.explode("slots").alias("s")).select(
        *place, (F.col("s.at") - F.col("item_pos") + F.col("pos")).alias("at"), F.col("s.value").alias("theirs")
    )
    slotted = shared_table(theirs.select("key1", "key2").distinct(), "slotted_documents")
    own = with_words(texts.join(_small(slotted), ["key1", "key2"], "left_semi")).select(
        "key1", "key2", F.explode(_slots(F.col("words"))).alias("s")
    )
    own = own.select("key1", "key2", F.col("s.at").alias("at"), F.col("s.value").alias("own")).distinct()
    pairs = theirs.join(own, ["key1", "key2", "at"])
    renamed = F.collect_set(F.struct("own", "theirs"))
    checked = pairs.groupBy(*place).agg(
        F.size(renamed).alias("both"),
        F.size(F.collect_set("own")).alias("n_own"),
        F.size(F.collect_set("theirs")).alias("n_theirs"),
        F.max(F.col("own") != F.col("theirs")).alias("changed"),
    )
    checked = shared_table(checked, "checked_windows")
    met = met.join(checked, place, "left").filter("size(slots) = 0 or (both = n_own and both = n_theirs)")
    # a window that matches in several readings is one
    plain = (F.col("reading") == "words") & (F.col("size") <= window)
    met = met.groupBy(*who, "item_id", "size", "pos", "item_pos").agg(
        F.min(F.coalesce("changed", F.lit(False))).alias("changed"), F.max(plain).alias("plain")
    )
    counts = met.groupBy(*who, "item_id", "plain").agg(
        F.count("*").alias("n_windows"),
        F.min("pos").cast("long").alias("first_word"),
        F.sum(F.col("changed").cast("long")).alias("n_changed"),
    )
    figures = F.max_by(F.struct("n_windows", "first_word", "n_changed"), "plain").alias("of")
    return counts.groupBy(*who, "item_id").agg(figures).select(*who, "item_id", "of.*")
