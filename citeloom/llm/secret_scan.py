"""Secret scans in DataFrame functions: base patterns, and sliding-window entropy of candidate strings.

Base kinds (code points, leftmost, not overlapping within a kind): ``assign``, a key word with an
assigned value; ``access``, an access key id; ``hex``, a long run of hexadecimal digits.

The entropy kinds scan candidate strings, long runs of one character class, with a window whose
Shannon entropy is kept up to date by incremental counts: each step adds the term of the character
that comes in and takes back the term of the one that goes out. A candidate is a finding if its
highest window entropy reaches its class's bound, no base span overlaps it, and no allow-list
pattern suppresses it.

* ``entropy_hex``: runs of [0-9A-F] with both, window 24, at least 3.0 bits
* ``entropy_lower``: runs of [a-z0-9] beyond hex digits, with three digits, window 24, at least 3.6 bits
* ``entropy_upper``: the same of [A-Z0-9]
* ``entropy_text``: runs of [A-Za-z0-9+/_=-] with both cases and digits, window 24, at least 3.9 bits

Work is near linear in the length of a text, of a candidate, and in the number of matches: arrays
that a step needs are bound once (``_let``), and running values are taken in blocks (``_running``).

Defined cases: a null text is the empty text, without spans; very long texts, candidates and match
lists are worked whole; repeated rows and null ids are scanned like other rows; an empty table gives
an empty result; extra columns are ignored. Only documents that hold a candidate pay for the scan of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: kind, pattern of the whole match, group that must be long enough, its least length
BASE_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: kind, pattern of a candidate, entropy bound in bits
ENTROPY_KINDS = (
    ("entropy_hex", r"(?<![A-Za-z0-9+/_=-])(?=[A-F]*[0-9])(?=[0-9]*[A-F])[0-9A-F]{24,}(?![A-Za-z0-9+/_=-])", 3.0),
    ("entropy_lower", r"(?<![A-Za-z0-9+/_=-])(?=(?:[a-z]*[0-9]){3})(?=[0-9a-f]*[g-z])[a-z0-9]{24,}(?![A-Za-z0-9+/_=-])", 3.6),
    ("entropy_upper", r"(?<![A-Za-z0-9+/_=-])(?=(?:[A-Z]*[0-9]){3})(?=[0-9A-F]*[G-Z])[A-Z0-9]{24,}(?![A-Za-z0-9+/_=-])", 3.6),
    ("entropy_text", r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{24})(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]+", 3.9),
)
#: Every hex span and every candidate has such a run, every assign span one of these characters,
#: every access span this text: cheap tests that spare most texts the patterns.
LONG_RUN = r"[A-Za-z0-9+/_=-]{24}"
WINDOW = 24
#: Elements of one block of a running value.
BLOCK = 256
#: Strings that are no secrets though they look random: placeholders, sequences, paths, repeated
#: marks. A path is the whole candidate: words, with a short number each at most, between separators.
ALLOWED = (
    r"(?i:example|placeholder|changeme|dummy|sample|xxxx|0123456789|1234567890|abcdefgh)",
    r"^[/_=+-]*(?:[A-Za-z]{2,}[0-9]{0,4}[/_=+-]+)+(?:[A-Za-z]*[0-9]{0,4})$",
    r"([A-Za-z0-9+/_=-])\1{5}",
)
KIND_ORDER = tuple(k[0] for k in BASE_KINDS) + tuple(k[0] for k in ENTROPY_KINDS)
_SPAN = "struct<start:int,kind:int,`end`:int,found:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body's own lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, zero: Column, combine: Callable[[Column, Column], Column], kind: str) -> Column:
    """For each element the combination of those before it.

    Blocks are combined first, so that a growing array is copied within a block, and over the blocks.
    """

    def scan(array: Column) -> Column:
        begin = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        step = lambda s, x: F.struct(combine(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(array, begin, step, lambda s: s["out"])

    def in_blocks(blocks: Column) -> Column:
        wholes = F.transform(blocks, lambda b: F.aggregate(b, zero, combine))
        inner = lambda ahead: F.flatten(F.transform(blocks, lambda b, i: F.transform(scan(b), lambda x: combine(F.element_at(ahead, i + 1), x))))
        return _let(scan(wholes), inner)

    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / BLOCK).cast("int"))
        return _let(F.transform(starts, lambda j: F.slice(v, j * BLOCK + 1, BLOCK)), in_blocks)

    return _let(values, cut)


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Start, kind, end and string of each match, in code points: texts between matches give the places."""
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.transform(F.split(text, pattern, -1), lambda b: F.char_length(b))

    def placed(matches: Column) -> Column:
        sizes = F.transform(matches, lambda m: F.char_length(m))

        def with_gaps(steps: Column) -> Column:
            before = _running(F.transform(steps, lambda x: x["gap"] + x["size"]), F.lit(0), lambda a, b: a + b, "int")
            whole = F.arrays_zip(matches.alias("found"), steps.alias("step"), before.alias("before"))
            start = lambda x: x["before"] + x["step"]["gap"]
            return F.transform(whole, lambda x: F.struct(start(x).alias("start"), F.lit(kind).alias("kind"), (start(x) + x["step"]["size"]).alias("end"), x["found"].alias("found")))

        pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), sizes, lambda g, n: F.struct(g.alias("gap"), n.alias("size")))
        return _let(pairs, with_gaps)

    return _let(found, placed)


def _term(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def max_window_entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy, in bits a character, of the windows of an ASCII string.

    The state holds the counts of the string's characters and the sum of count * log2(count); a step
    changes the two counts that the window's move changes.
    """

    def scan(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            comes = F.element_at(codes, i)
            goes = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(0).cast("long"))
            has_in, has_out = F.element_at(state["counts"], comes.cast("int")), F.element_at(state["counts"], F.greatest(goes, F.lit(1)).cast("int"))
            change = _term(has_in + 1) - _term(has_in) + F.when(goes > 0, _term(has_out - 1) - _term(has_out)).otherwise(F.lit(0.0))
            total = state["total"] + F.when(comes == goes, F.lit(0.0)).otherwise(change)
            counts = F.transform(state["counts"], lambda c, at: c + (at + 1 == comes).cast("int") - (at + 1 == goes).cast("int"))
            entropy = F.log2(F.lit(float(window))) - total / window
            best = F.when(i >= window, F.greatest(state["best"], entropy)).otherwise(state["best"])
            return F.struct(counts.alias("counts"), total.alias("total"), best.alias("best"))

        begin = F.struct(F.array_repeat(F.lit(0), F.array_max(codes).cast("int")).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), begin, step, lambda s: s["best"])

    # Characters by their places in the string's own alphabet.
    numbered = lambda chars: _let(F.array_distinct(chars), lambda alphabet: _let(F.transform(chars, lambda c: F.array_position(alphabet, c)), scan))
    return _let(F.split(value, ""), numbered)


def _with_long_group(spans: Column, pattern: str, group: int, least: int) -> Column:
    return F.filter(spans, lambda s: F.char_length(F.regexp_extract(s["found"], pattern, group)) >= least)


def _random_ones(base: Column, candidates: Column) -> Column:
    """Candidates that no base span overlaps, no allow-list pattern suppresses, and that reach their bound.

    In the order of all spans, a candidate overlaps a base span before it if the highest end so far
    is beyond its start, and one after it if the lowest start to come is before its end.
    """
    bounds = F.array(*[F.lit(bits) for _, _, bits in ENTROPY_KINDS])
    is_base = lambda s: s["kind"] < len(BASE_KINDS)
    far = F.lit(2**31 - 1)

    def free(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(F.lit(-1)))
        starts = F.transform(F.reverse(spans), lambda s: F.when(is_base(s), s["start"]).otherwise(far))
        highest = _running(ends, F.lit(-1), lambda a, b: F.greatest(a, b), "int")
        lowest = F.reverse(_running(starts, far, lambda a, b: F.least(a, b), "int"))
        whole = F.arrays_zip(spans.alias("span"), highest.alias("highest"), lowest.alias("lowest"))
        alone = F.filter(whole, lambda x: ~is_base(x["span"]) & (x["highest"] <= x["span"]["start"]) & (x["lowest"] >= x["span"]["end"]))
        return F.transform(alone, lambda x: x["span"])

    allowed = lambda s: s["found"].rlike("|".join(f"(?:{p})" for p in ALLOWED))
    left = F.filter(_let(F.array_sort(F.concat(base, candidates)), free), lambda s: ~allowed(s))
    return F.filter(left, lambda s: max_window_entropy(s["found"]) >= F.element_at(bounds, s["kind"] - len(BASE_KINDS) + 1))


def scan_secrets(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id and ``findings``, an array of (start, kind, end, found, name) in order."""
    none = F.array().cast(f"array<{_SPAN}>")
    text = F.col("t")
    possible = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), F.contains(text, F.lit("AKIA")), F.col("long_run"))
    base = []
    for k, (_, pattern, group, least) in enumerate(BASE_KINDS):
        # A run of one class that is long enough is a match of the bounded pattern, and no other is.
        exact = pattern if group else pattern[:-1] + f"{{{least - (4 if pattern.startswith('AKIA') else 0)},}}"
        spans = _spans(text, exact, k)
        if group:
            spans = _with_long_group(spans, pattern, group, least)
        base.append(F.when(possible[k] & text.rlike(exact), spans).otherwise(none))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("long_run", text.rlike(LONG_RUN))
    rows = rows.withColumn("base", F.concat(*base))
    found = [F.when(text.rlike(pattern), _spans(text, pattern, k)).otherwise(none) for k, (_, pattern, _) in enumerate(ENTROPY_KINDS, len(BASE_KINDS))]
    rows = rows.withColumn("candidates", F.when(F.col("long_run"), F.concat(*found)).otherwise(none))
    more = F.when(F.size("candidates") > 0, _random_ones(F.col("base"), F.col("candidates"))).otherwise(none)
    names = F.array(*[F.lit(k) for k in KIND_ORDER])
    spans = F.array_sort(F.concat(F.col("base"), more))
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.element_at(names, s["kind"] + 1).alias("name"), s["found"].alias("found")))
    return rows.select(F.col("id").alias(id_col), named.alias("findings"))


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    said = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("findings", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("findings", lambda s: s["kind"] < len(BASE_KINDS))
    return scanned.select(
        id_col,
        *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE_KINDS)],
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("findings")).alias("spans"),
    )
