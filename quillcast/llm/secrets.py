"""Secret scans: patterns, and guess costs of values in a credential's place.

A value that follows a credential word is split into words, dates, repeats, keyboard
walks and brute-force spans so that the guesses needed are least; dynamic programming
finds that split. Values that take too many guesses for a placeholder are secrets.

Words are those of the corpus: the parts of all values are counted as words of all texts,
and a word of which there is one in n takes n guesses.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import counted, narrowed, slices, split_words
from quillcast.session import written

KINDS = ("assign", "access", "hex", "guess")

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: A text without any of these, in either case, holds no credential word.
CLUES = ("passw", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "access-key", "accesskey", "credential", "bearer")
CONTEXT = re.compile(
    r"""(?ai:(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?)["']?\x20*(?:[:=]|=>|\x20is\x20)\x20*["'<]?|bearer\x20+)([^\s"'<>]{8,})"""
)

#: The same place in lower-case text, value included, for Spark's functions.
CONTEXT_JAVA = (
    r"""(?:(?:password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|credentials?)["']?\x20*(?:[:=]|=>|\x20is\x20)\x20*["'<]?|bearer\x20+)[^\s"'<>]{8,}"""
)

#: Guesses from which a value counts as a secret: ten to this power.
SECRET_POWER = 12.0
#: Frequent parts of passwords and placeholders, known without a corpus; a word's guesses are its place here.
COMMON = (
    "password passwd secret token key api example test changeme default admin root user login welcome letmein "
    "master hello qwerty abc your my the value here none null true false placeholder sample dummy demo foo bar baz "
    "name access private public auth config env production staging local host server client data service account"
).split()
#: Lengths of the parts of values that are looked up as words of the corpus.
WORD_SIZES = range(3, 21)
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
#: Starting another part of a split, and a sign that only separates two parts.
PART_COST = math.log10(4)
SEPARATORS, SEPARATOR_COST = "_-. /", math.log10(4)
#: Lengths of units that are said several times.
UNITS = range(2, 9)
#: Another than the usual case of a word.
CASE_COST = 1.0

RANK = {word: math.log10(place + 1) for place, word in enumerate(COMMON, 1)}
NEXT = {(a, b) for row in ROWS for line in (row, row[::-1]) for a, b in zip(line, line[1:], strict=False)}


def character_cost(value: str) -> float:
    """Decimal digits of guesses for a brute-force character: the alphabet that the value draws on.

    A capital at the start and separators between parts don't widen the alphabet.
    """
    size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value[1:]) + 10 * any(c.isdigit() for c in value)
    size += 33 * any(c.isascii() and not c.isalnum() and c not in SEPARATORS for c in value) + 100 * any(not c.isascii() for c in value)
    return math.log10(max(size, 10))


def guess_power(value: str, words: Mapping[str, float] = RANK) -> float:
    """Decimal logarithm of the least guesses over all splits of the value.

    ``words`` holds the decimal logarithm of each known lower-case word's guesses. Walks,
    repeats and repeated units are taken from where they begin; other parts are tried at every place.
    """
    n, low = len(value), value.lower() if value.isascii() else value
    longest, price = max(map(len, words), default=0), character_cost(value)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * (n + 1)  # ends in a brute-force span
    dates: dict[int, list[int]] = {}
    for at in range(n):
        if value[at].isdigit() and (found := DATE.match(value, at)):
            dates.setdefault(found.end(), []).append(at)
    walk = repeat = 0
    again = dict.fromkeys(UNITS, 0)  # characters up to here that equal the one so many before
    for end in range(1, n + 1):
        brute[end] = min(brute[end - 1], best[end - 1] + PART_COST) + price
        options = [brute[end]]
        if value[end - 1] in SEPARATORS:
            options.append(best[end - 1] + SEPARATOR_COST)
        walk = walk + 1 if end > 1 and (low[end - 2], low[end - 1]) in NEXT else 0
        repeat = repeat + 1 if end > 1 and value[end - 2] == value[end - 1] else 0
        for run, start_cost in ((walk, 2.0), (repeat, price)):
            if run >= 2:
                options.append(best[end - run - 1] + PART_COST + start_cost + math.log10(run + 1))
        for size in range(2, min(longest, end) + 1):
            part = low[end - size : end]
            if part in words:
                same = value[end - size : end] == part
                options.append(best[end - size] + PART_COST + words[part] + (0.0 if same else CASE_COST))
        options += [best[begin] + PART_COST + math.log10(365 * 120) for begin in dates.get(end, ())]
        # A unit of up to eight characters said again: the guesses of one, times how often.
        for size in UNITS:
            again[size] = again[size] + 1 if end > size and value[end - 1] == value[end - 1 - size] else 0
            if times := again[size] // size:
                options.append(best[end - times * size] + math.log10(times + 1))
        best[end] = min(options)
    return best[n]


def _has_clue(text: str) -> bool:
    low = text.lower()
    return any(clue in low for clue in CLUES)


def patterns(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the fixed patterns find, in code points, end exclusive."""
    found = []
    if _has_clue(text):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def values(text: str) -> list[tuple[int, str]]:
    """(start, value) of what stands in a credential's place."""
    found = [(m.start(1), m[1].rstrip(".,;:)]}")) for m in CONTEXT.finditer(text)] if _has_clue(text) else []
    return [(start, value) for start, value in found if len(value) >= 8]


def parts(value: str) -> Iterator[str]:
    """The value's parts that may be words: lower-case letters of the sizes in ``WORD_SIZES``."""
    for run in re.finditer(r"[a-z]+", value.lower() if value.isascii() else value):
        for at in range(run.start(), run.end()):
            for size in WORD_SIZES:
                if at + size <= run.end():
                    yield run.string[at : at + size]


def spans(text: str | None, words: Mapping[str, float] = RANK) -> list[tuple[int, int, str]]:
    """(start, end, kind) of one text, by start and then kind."""
    text = text or ""
    found = patterns(text)
    found += [(start, start + len(value), "guess") for start, value in values(text) if guess_power(value, words) >= SECRET_POWER]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def corpus_words(text: Column) -> Column:
    """Lower-case words of ASCII letters, without what stands in a credential's place."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), CONTEXT_JAVA, " ")
    return split_words(plain, "[^a-z]+")


def word_powers(docs: DataFrame, known: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, power): log10 of how many words of all texts there are for each one that is ``word``.

    ``known`` is a written table of distinct words; those that no text holds are left out.
    """
    texts = narrowed(docs, text=text_col).select(corpus_words(F.col("text")).alias("words"))
    total = texts.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    found = counted(texts.select(F.explode("words").alias("word")), known, "word")
    return found.select("word", F.log10(F.lit(float(total)) / F.col("n")).alias("power"))


def strong_values(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(value) of a written table of distinct values that take ``SECRET_POWER`` or more, with all texts' words known."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("value").to_pylist():
                chunk: set[str] = set()
                for part in parts(value):
                    chunk.add(part)
                    if len(chunk) == 10_000:
                        yield pa.RecordBatch.from_pydict({"value": [value] * len(chunk), "word": list(chunk)})
                        chunk = set()
                if chunk:
                    yield pa.RecordBatch.from_pydict({"value": [value] * len(chunk), "word": list(chunk)})

    held = written(found.mapInArrow(cut, "value string, word string"), "value-parts")
    powers = written(word_powers(docs, written(held.select("word").distinct(), "parts"), text_col), "word-powers")
    per_value = held.join(powers, "word").groupBy("value").agg(F.collect_set(F.struct("word", "power")).alias("words"))

    @F.pandas_udf("double")
    def power(texts: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([guess_power(value, _with_common(words)) for value, words in zip(texts, known, strict=True)], dtype="float64")

    return found.join(per_value, "value", "left").where(power("value", "words") >= SECRET_POWER).select("value")


def _with_common(words) -> dict[str, float]:
    known = dict(RANK)
    for row in () if words is None else words:
        known[row["word"]] = min(row["power"], known.get(row["word"], math.inf))
    return known


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<start, end, kind>>) per row of ``docs``, from whole texts.

    Kinds: ``assign`` a value given to a credential word, ``access`` an access key id,
    ``hex`` a long hexadecimal run, ``guess`` a value in a credential's place that takes
    many guesses. Null and empty texts have no spans; repeated rows come back repeated,
    null ids stay, an empty table gives no rows. Other columns are ignored. Equal values
    are judged alike wherever they stand; a value of any length is judged whole.
    """
    span = "struct<start: long, end: long, kind: string>"
    schema = f"row long, id {docs.schema[id_col].dataType.simpleString()}, spans array<{span}>, found array<struct<start: long, value: string>>"
    arrow = pa.schema([
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))),
        ("found", pa.list_(pa.struct([("start", pa.int64()), ("value", pa.string())]))),
    ])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            spans = [[{"start": a, "end": b, "kind": kind} for a, b, kind in patterns(text)] for text in texts]
            found = [[{"start": at, "value": value} for at, value in values(text)] for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(spans, arrow.field("spans").type), pa.array(found, arrow.field("found").type)],
                names=["row", "id", "spans", "found"],
            )

    # Numbers of rows are fixed once they are written.
    rows = narrowed(docs, id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    scanned = written(rows.mapInArrow(searched, schema), "scanned")
    placed = scanned.select("row", F.inline("found"))
    strong = written(strong_values(written(placed.select("value").distinct(), "values"), docs, text_col), "strong-values")
    end = F.col("start") + F.char_length("value")
    guessed = (
        placed.join(strong, "value")
        .groupBy("row").agg(F.collect_list(F.struct("start", end.alias("end"), F.lit("guess").alias("kind"))).alias("guessed"))
    )
    # Rows without such values, most of them, are not shuffled.
    held = scanned.where(F.size("found") > 0).join(written(guessed, "guessed"), "row", "left")
    none = F.array().cast(f"array<{span}>")
    joined = held.select("id", F.concat("spans", F.coalesce("guessed", none)).alias("spans"))
    every = scanned.where(F.size("found") == 0).select("id", "spans").unionAll(joined)
    kinds = F.array(*(F.lit(kind) for kind in KINDS))
    keyed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    ordered = F.transform(F.array_sort(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return every.select("id", ordered.alias("spans"))


def masked(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    return "".join(_masked(text, found))


def _masked(text: str, found: list[tuple[int, int, str]]) -> Iterator[str]:
    at = 0
    for start, end, kind in found:
        if end > at:
            yield text[at : max(start, at)]
            if start >= at:
                yield f"<{kind}>"
            at = end
    yield text[at:]
