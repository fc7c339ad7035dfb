"""Quality rules: counts of words, symbols and repeats, and divergence from language references.

Each document's histograms of character classes and of common words of its language are compared
with the language's own references by the Jensen-Shannon distance (base 2, 0 to 1).  References are
the mean histograms of all documents of a language, so they follow the corpus.  Documents too short
for a histogram to mean anything are not judged by it.

With own limits, how far a document may be follows from its language's own distances at its length:
few words are always further from a mean than many, and a text without any common word is at a
distance that depends on the language's share of them.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accessgrid.llm.common import ascii_tokens, freeing, written

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Length guards: histograms of fewer characters or words are not compared.
MIN_CHARS_COMPARED, MIN_WORDS_COMPARED = 200, 50
#: Largest distances that pass.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.45, 0.85
#: Own limits of characters: so many times the upper quartile of the documents of the same length.
CHAR_TIMES = 2
#: Own limits of words: the median and so many times what the upper quartile is above it, a share of
#: the median at least (near copies are close together).
WORD_SPREADS, WORD_MARGIN = 4, 0.25
#: Own limits are not less.
MIN_LIMIT = 0.1
#: Languages with fewer comparable documents have no reference of their own: their documents, like those
#: without a language, are compared with the reference and the limits of all documents.  The nearest octave
#: of lengths with as many documents gives the limits.
MIN_REFERENCE_DOCS = 20
#: The group of all documents; those of languages begin with another character.
ALL = "*"

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
# Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in a is that it for on was be with as by this are or at from an not have which you he they but his her had we were all their one has there been if more when who will no out so what up".split(),
    "de": "der die und das in zu den ist von mit sich des auf für nicht ein dem eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über so zum war haben nur oder aber vor zur bis mehr durch".split(),
    "fr": "le la de et les des en un une du que est pour qui dans par sur il au ne se ce plus pas avec son elle ont sa mais comme ou nous aux leur cette été était fait ces sont ses être deux même aussi tout où".split(),
    "es": "de la que el en y a los se del las por un para con no una su al lo como más o pero sus le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había era muy años hasta desde está mi porque".split(),
}
# Classes of characters by their first UTF-8 byte.
CLASSES = ["lower", "upper", "digit", "space", "feed", "stop", "symbol", "other", "latin", "wide"]


def _class_of_bytes() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"))
    for chars, name in (
        (b"abcdefghijklmnopqrstuvwxyz", "lower"),
        (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "upper"),
        (b"0123456789", "digit"),
        (b" \t", "space"),
        (b"\n\r\x0b\x0c", "feed"),
        (b".,;:!?'\"()-", "stop"),
        (SYMBOLS, "symbol"),
    ):
        out[list(chars)] = CLASSES.index(name)
    out[0x80:0xC0] = len(CLASSES)  # later bytes of a character
    out[0xC0:0xCB] = CLASSES.index("latin")
    out[0xCB:] = CLASSES.index("wide")
    return out


_CLASS = _class_of_bytes()
_WORDS = {lang: {w: n for n, w in enumerate(words)} for lang, words in COMMON_WORDS.items()}
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_characters long, "
    "char_hist array<double>, words_of string, word_hist array<double>"
)


def _repeats(codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """For each text the words inside windows that its text holds twice or more."""
    out = np.zeros(n, np.int64)
    if len(codes) < WINDOW:
        return out
    count = len(codes) - WINDOW + 1
    with np.errstate(over="ignore"):
        hashed = np.zeros(count, np.uint64)
        for k in range(WINDOW):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
        hashed ^= hashed >> np.uint64(29)
        hashed = hashed * np.uint64(0xBF58476D1CE4E5B9) + rows[:count].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        hashed ^= hashed >> np.uint64(32)
    whole = np.flatnonzero(rows[:count] == rows[WINDOW - 1 :])
    order = whole[np.argsort(hashed[whole], kind="stable")]
    same = hashed[order][1:] == hashed[order][:-1]
    hits = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    marks = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marks, hits, 1)
    np.add.at(marks, hits + WINDOW, -1)
    np.add.at(out, rows[np.cumsum(marks[:-1]) > 0], 1)
    return out


_MIX = np.uint64(0xFF51AFD7ED558CCD)


def measure(texts: pa.Array, langs: list[str | None]) -> list[pa.Array]:
    """The columns of MEASURES for a batch of texts."""
    n = len(texts)
    filled = pc.fill_null(texts, "")
    cased = pc.ascii_split_whitespace(filled)
    words, rows = cased.flatten(), pc.list_parent_indices(cased)
    full = pc.not_equal(pc.binary_length(words), 0)
    words, rows = words.filter(full), rows.filter(full).to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = np.bincount(rows, minlength=n)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
    with np.errstate(over="ignore"):
        codes = (codes + np.uint64(1)) * _MIX
        codes ^= codes >> np.uint64(33)
    repeats = _repeats(codes, rows, n)
    word_chars = np.bincount(rows, weights=pc.utf8_length(words).to_numpy(zero_copy_only=False), minlength=n).astype(np.int64)

    symbols, dup_lines, chars, char_hist, words_of, word_hist = [], [], [], [], [], []
    low, low_rows = ascii_tokens(filled)
    starts = np.searchsorted(low_rows, np.arange(n + 1))
    for at, text in enumerate(filled.to_pylist()):
        data = text.encode()
        counts = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]
        symbols.append(len(data) - len(data.translate(None, SYMBOLS)))
        chars.append(int(counts.sum()))
        char_hist.append((counts / max(1, counts.sum())).tolist())
        lines = [line for line in data.split(b"\n") if line.strip(SPACE)]
        dup_lines.append(len(lines) - len(set(lines)))
        own = low.slice(starts[at], starts[at + 1] - starts[at])
        lang = langs[at] if langs[at] in _WORDS else _nearest(own)
        common = _WORDS[lang]
        found = pc.value_counts(own.filter(pc.is_in(own, value_set=_SETS[lang])))
        hist = np.zeros(len(common) + 1)
        for w, c in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
            hist[common[w]] = c
        hist[-1] = n_words[at] - hist.sum()
        words_of.append(lang)
        word_hist.append((hist / max(1, n_words[at])).tolist())
    longs = [pa.array(np.asarray(x), pa.int64()) for x in (n_words, word_chars, symbols, dup_lines, repeats, chars)]
    return [*longs, pa.array(char_hist, pa.list_(pa.float64())), pa.array(words_of, pa.string()), pa.array(word_hist, pa.list_(pa.float64()))]


_SETS = {lang: pa.array(words) for lang, words in COMMON_WORDS.items()}


def _nearest(words: pa.Array) -> str:
    """The language whose common words stand most often among the words; of equals the first."""
    return max(sorted(_SETS), key=lambda lang: pc.sum(pc.is_in(words, value_set=_SETS[lang])).as_py() or 0)


def measures(df: DataFrame, text: str, lang: str, *keep: str) -> DataFrame:
    """keep, `_lang` and the columns of MEASURES; null texts count as empty."""
    kept = df.select(*keep, F.col(lang).cast("string").alias("_lang")).schema
    schema = T.StructType(kept.fields + T.StructType.fromDDL(MEASURES).fields)
    names = schema.names

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                cut = batch.slice(start, 500)
                made = measure(cut.column(cut.num_columns - 1), cut.column(cut.num_columns - 2).to_pylist())
                yield pa.RecordBatch.from_arrays([*cut.columns[:-1], *made], names=names)

    return df.select(*keep, F.col(lang).cast("string").alias("_lang"), F.col(text).cast("string").alias("_text")).mapInArrow(freeing(run), schema)


def _entropy(h: Column) -> Column:
    return F.aggregate(h, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms that sum to 1: 0 if equal, 1 if disjoint."""
    middle = F.zip_with(p, q, lambda a, b: (a + b) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), _entropy(middle) - (_entropy(p) + _entropy(q)) / 2))


def references(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, char_ref) of each language with enough comparable documents and of all documents, and
    (words_of, word_ref): mean histograms."""
    fits = measured.filter((F.col("n_characters") >= MIN_CHARS_COMPARED) & (F.col("n_words") >= MIN_WORDS_COMPARED))
    width = max(map(len, COMMON_WORDS.values())) + 1
    sums = lambda name, n: [F.sum(F.get(name, F.lit(i))).alias(f"s{i}") for i in range(n)]
    means = lambda n: F.array(*[F.col(f"s{i}") / F.col("n") for i in range(n)])
    chars = written(fits.groupBy("_lang").agg(F.count("*").alias("n"), *sums("char_hist", len(CLASSES))))
    own = chars.filter(F.col("_lang").isNotNull() & (F.col("n") >= MIN_REFERENCE_DOCS))
    own = own.select(F.concat(F.lit("="), "_lang").alias("group"), means(len(CLASSES)).alias("char_ref"))
    every = chars.agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(CLASSES))])
    every = every.filter("n > 0").select(F.lit(ALL).alias("group"), means(len(CLASSES)).alias("char_ref"))
    words = fits.groupBy("words_of").agg(F.count("*").alias("n"), *sums("word_hist", width))
    words = words.select("words_of", F.filter(means(width), lambda x: x.isNotNull()).alias("word_ref"))
    return own.union(every), words


def compared(measured: DataFrame) -> DataFrame:
    """Adds group, char_distance, all_distance and word_distance (null: too short to be compared), and
    none_distance, that of a text without any common word.

    Characters are compared with those of the document's group: its language, or all documents where
    that has few; all_distance is from all documents.  Words are compared with those of the language
    itself, or of the one whose common words the text has most of.
    """
    long_enough = (F.col("n_characters") >= MIN_CHARS_COMPARED, F.col("n_words") >= MIN_WORDS_COMPARED)
    chars, words = (written(r) for r in references(measured))  # a row for each language
    every = chars.filter(F.col("group") == ALL).select(F.col("char_ref").alias("all_ref")).scalar()
    own = chars.select("group", "char_ref")
    joined = measured.join(own, F.concat(F.lit("="), "_lang") == F.col("group"), "left")
    joined = joined.withColumns({"group": F.coalesce("group", F.lit(ALL)), "all_ref": every}).join(words, "words_of", "left")
    none = F.transform("word_ref", lambda x, i: F.when(i == F.size("word_ref") - 1, 1.0).otherwise(0.0))
    worded = long_enough[1] & F.col("word_ref").isNotNull()
    return joined.withColumns({
        "char_distance": F.when(long_enough[0] & F.col("all_ref").isNotNull(), divergence(F.col("char_hist"), F.coalesce("char_ref", "all_ref"))),
        "all_distance": F.when(long_enough[0] & F.col("all_ref").isNotNull(), divergence(F.col("char_hist"), F.col("all_ref"))),
        "word_distance": F.when(worded, divergence(F.col("word_hist"), F.col("word_ref"))),
        "none_distance": F.when(worded, divergence(none, F.col("word_ref"))),
    }).drop("char_hist", "word_hist", "char_ref", "word_ref", "all_ref")


def own_limits(distances: DataFrame) -> DataFrame:
    """(group, char, word): for each octave of lengths the documents there, their limit and upper quartile.

    Groups are languages and all documents for characters, and the languages of the words for words.

    Documents of one length and distance (copies) count once.  Distances of words fall with the root of
    the length, so they are held as those of the octave's shortest text.  Quartiles are exact to 1/1000,
    over counts of distances: a group has 1,415 of them at most, whatever the data holds.
    """
    entry = lambda kind, group, n, d: F.struct(F.lit(kind).alias("kind"), group.alias("group"), F.col(n).alias("n"), F.col(d).alias("d"))
    own = F.when(F.col("group") != ALL, F.col("group"))
    kinds = F.array(
        entry("char", own, "n_characters", "char_distance"), entry("char", F.lit(ALL), "n_characters", "all_distance"), entry("word", F.col("words_of"), "n_words", "word_distance")
    )
    rows = distances.select(F.explode(kinds).alias("r")).select("r.*").filter("d IS NOT NULL AND group IS NOT NULL").distinct()
    placed = rows.withColumn("octave", F.floor(F.log2("n")).cast("int"))
    scale = F.when(F.col("kind") == "word", F.sqrt(F.col("n") / F.pow(F.lit(2.0), "octave"))).otherwise(1.0)
    group = ("group", "kind", "octave")
    cells = placed.groupBy(*group, F.round(1000 * F.col("d") * scale).alias("cell")).agg(F.count("*").alias("n"))
    found = cells.groupBy(*group).agg(F.sum("n").alias("docs"), F.percentile("cell", [0.5, 0.75], F.col("n")).alias("q"))
    middle, upper = F.col("q")[0] / 1000, F.col("q")[1] / 1000
    above = F.greatest(WORD_SPREADS * (upper - middle), WORD_MARGIN * middle)
    limit = F.when(F.col("kind") == "char", CHAR_TIMES * upper).otherwise(middle + above)
    entry = F.struct("octave", "docs", limit.alias("limit"), upper.alias("upper"))
    own = lambda kind: F.collect_list(F.when(F.col("kind") == kind, entry)).alias(kind)
    return found.groupBy("group").agg(own("char"), own("word"))


def _entry(entries: str, n: str) -> Column:
    """The entry of the nearest octave with enough documents, or of the octave with the most."""
    octave = F.floor(F.log2(F.greatest(F.col(n), F.lit(1)))).cast("int")
    rank = lambda x: F.struct(
        (-F.least(x["docs"], F.lit(MIN_REFERENCE_DOCS))).alias("few"), F.abs(x["octave"] - octave).alias("far"), x["octave"].alias("octave"), x["limit"].alias("limit"), x["upper"].alias("upper")
    )
    return F.array_min(F.transform(entries, rank))


def limited(distances: DataFrame) -> DataFrame:
    """Adds char_limit and word_limit from own_limits (null: nothing to compare).

    A limit of words is at most midway from the upper quartile to a text without common words.
    """
    found = written(own_limits(distances))  # a row for each language
    chars = found.filter(F.size("char") > 0).select("group", "char")
    words = found.filter(F.size("word") > 0).select(F.col("group").alias("words_of"), "word")
    both = distances.join(chars, "group", "left").join(words, "words_of", "left")
    both = both.withColumns({"_c": _entry("char", "n_characters"), "_w": _entry("word", "n_words")})
    # Longer texts than those of the entry have the limit of its longest.
    scale = F.least(F.sqrt(F.col("n_words") / F.pow(F.lit(2.0), F.col("_w.octave"))), F.sqrt(F.lit(2.0)))
    upper = F.col("_w.upper") / scale
    midway = F.when(F.col("none_distance") > upper, (upper + F.col("none_distance")) / 2)
    at_least = lambda c: F.when(c.isNotNull(), F.greatest(c, F.lit(MIN_LIMIT)))
    made = {"char_limit": at_least(F.col("_c.limit")), "word_limit": at_least(F.least(F.col("_w.limit") / scale, midway))}
    return both.withColumns(made).drop("char", "word", "_c", "_w")


def judged(distances: DataFrame) -> DataFrame:
    """Adds base_failed and kept: within the fixed limits, and within char_limit and word_limit if there."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    near = F.lit(True)
    for kind, most in (("char", MAX_CHAR_DISTANCE), ("word", MAX_WORD_DISTANCE)):
        limit = F.least(F.lit(most), f"{kind}_limit") if f"{kind}_limit" in distances.columns else F.lit(most)
        near &= F.coalesce(F.col(f"{kind}_distance") <= limit, F.lit(True))
    return distances.withColumn("base_failed", failed).withColumn("kept", ~failed & near)


def quality(df: DataFrame, *keep: str, text: str = "text", lang: str = "lang", by_own_limits: bool = False) -> DataFrame:
    """keep, the measures, base_failed, both distances and kept, a row for each row of df.

    Null and empty texts have no words and fail the base rule.  Documents without a language, or in
    one with few documents, are held to the reference and limits of all documents.  Repeated rows are
    judged alike.
    by_own_limits: distances are held to the limits of each language's own distances too; the fixed
    ones alone hardly ever reject by words.
    """
    distances = compared(written(measures(df, text, lang, *keep)))
    made = judged(limited(written(distances)) if by_own_limits else distances)
    return made.drop("_lang", "words_of", "group", "n_characters", "all_distance", "none_distance", "char_limit", "word_limit")
