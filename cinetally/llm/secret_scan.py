"""Secret scans in built-in functions.

Three patterns find secrets by their form. Besides, long strings are searched
with a sliding window for high Shannon entropy: the counts of the characters
in the window are kept from step to step, as one enters and one leaves. Each
class of strings has its own threshold, and an allow list suppresses known
harmless forms. Places are counted in code points.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from cinetally.llm.common import col, text_of

#: The forms that are searched (fixed patterns), and how long a match must be.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Strings whose entropy is measured.
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
#: Classes of candidates: the patterns that all must occur, and the least entropy of a window in bits. The first that fits holds.
CLASSES = (
    ("hex", (r"^([0-9a-f]+|[0-9A-F]+)$", r"[0-9]"), 2.9),
    ("base64", (r"[a-z]", r"[A-Z]", r"[0-9]"), 3.6),
    ("alnum", (r"[A-Za-z]", r"[0-9]"), 3.4),
)
#: Candidates that are no secrets: numbers, UUIDs, placeholders.
ALLOWED = (
    r"^[0-9]+$",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)example|placeholder|changeme|xxxx|0000000|1234567",
)
#: Unless scans are not to be thorough: classes of candidates without a digit, and the allowed words, which windows must not touch.
LETTERS = (
    ("mixed letters", (r"[a-z]", r"[A-Z]"), 3.5),
    ("letters", (r"[A-Za-z]",), 3.4),
)
ALLOWED_FORMS = ALLOWED[:2]
ALLOWED_WORDS = r"(?i)example|placeholder|changeme|x{4,}|0{7,}|1234567"
#: Sums of logarithms differ in the last digits with the order of the steps.
NEAR = 1e-9

_SPANS = "array<struct<start:int,kind:int,end:int,found:string>>"


def _spans(name: str, kind: int) -> str:
    """Places of the matches in column ``name``, from the texts between them in ``name_gaps``."""
    begin = f"state.at + length({name}_gaps[i])"
    end = f"{begin} + length({name}[i])"
    span = f"named_struct('start', {begin}, 'kind', {kind}, 'end', {end}, 'found', {name}[i])"
    return f"""CASE WHEN size({name}) > 0 THEN aggregate(
        sequence(0, size({name}) - 1),
        named_struct('at', 0, 'spans', cast(array() AS {_SPANS})),
        (state, i) -> named_struct('at', {end}, 'spans', concat(state.spans, array({span}))),
        state -> state.spans) ELSE cast(array() AS {_SPANS}) END"""


def _dense_part(found: str, least: str) -> str:
    """First and last window (from 0) of a string whose entropy is at least that, null where there is none.

    The state holds the counts as a string with a character per letter of the
    alphabet, and the sum of count * log2(count). A window is judged in the
    step after its last character came in, so there is one step more.
    """
    entering, leaving = f"substring({found}, i, 1)", f"substring({found}, i - {WINDOW}, 1)"
    table = ", ".join(repr(n * math.log2(n) if n else 0.0) + "D" for n in range(WINDOW + 1))

    def count(letter: str) -> str:
        return f"(ascii(substring(state.counts, instr('{ALPHABET}', {letter}), 1)) - 48)"

    def moved(counts: str, letter: str, by: int) -> str:
        return f"overlay({counts} PLACING char({count(letter)} + {48 + by}) FROM instr('{ALPHABET}', {letter}) FOR 1)"

    def bits(letter: str, by: int) -> str:
        return f"(array({table})[{count(letter)} + {by}] - array({table})[{count(letter)}])"

    stays = f"i > length({found}) OR (i > {WINDOW} AND {entering} = {leaving})"
    dense = f"i > {WINDOW} AND {math.log2(WINDOW)!r}D - state.total / {WINDOW} >= {least} - {NEAR!r}D"
    both = moved(moved("state.counts", entering, 1), leaving, -1)
    return f"""aggregate(
        sequence(1, length({found}) + 1),
        named_struct('counts', '{"0" * len(ALPHABET)}', 'total', 0D, 'first', cast(null AS int), 'last', cast(null AS int)),
        (state, i) -> named_struct(
            'counts', CASE WHEN {stays} THEN state.counts WHEN i > {WINDOW} THEN {both} ELSE {moved("state.counts", entering, 1)} END,
            'total', CASE WHEN {stays} THEN state.total WHEN i > {WINDOW} THEN state.total + {bits(entering, 1)} + {bits(leaving, -1)}
                     ELSE state.total + {bits(entering, 1)} END,
            'first', CASE WHEN state.first IS NULL AND {dense} THEN i - {WINDOW} - 1 ELSE state.first END,
            'last', CASE WHEN {dense} THEN i - {WINDOW} - 1 ELSE state.last END),
        state -> named_struct('first', state.first, 'last', state.last))"""


def _pieces(x: str) -> str:
    """The candidate ``x`` as an array of spans: its stretches between allowed words that a window fits in, none if all of it is allowed."""
    allowed = " OR ".join(f"{x}.found RLIKE r'{p}'" for p in ALLOWED_FORMS)
    parts = f"split({x}.found, r'{ALLOWED_WORDS}', -1)"
    words = f"concat(array(''), regexp_extract_all({x}.found, r'{ALLOWED_WORDS}', 0))"
    spans = f"""aggregate(
        zip_with({parts}, {words}, (part, word) -> named_struct('part', part, 'word', word)),
        named_struct('at', {x}.start, 'spans', cast(array() AS {_SPANS})),
        (state, p) -> named_struct(
            'at', state.at + length(p.word) + length(p.part),
            'spans', CASE WHEN length(p.part) < {WINDOW} THEN state.spans ELSE concat(state.spans, array(named_struct(
                'start', state.at + length(p.word), 'kind', {x}.kind, 'end', state.at + length(p.word) + length(p.part), 'found', p.part))) END),
        state -> state.spans)"""
    return f"CASE WHEN {allowed} THEN cast(array() AS {_SPANS}) WHEN {x}.found RLIKE r'{ALLOWED_WORDS}' THEN {spans} ELSE array({x}) END"


def _least_entropy(found: str, allowed=ALLOWED, classes=CLASSES) -> str:
    """The threshold of a candidate's class, null for candidates that are not to be measured."""
    allowed = " OR ".join(f"{found} RLIKE r'{p}'" for p in allowed) or "false"
    classes = " ".join(
        f"WHEN {' AND '.join(f"{found} RLIKE r'{p}'" for p in patterns)} THEN {least!r}D" for _, patterns, least in classes
    )
    return f"CASE WHEN {allowed} THEN cast(null AS double) {classes} END"


def _listed(spans: str) -> str:
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat_ws(':', {kinds}[x.kind], x.start, x.end)), ',')"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, thorough: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy.

    ``spans`` lists kind:start:end of all finds by start, then kind, with the
    end exclusive; an entropy span reaches from the first to the last dense
    window of its string. ``base_sha256`` is the digest of the same list
    without the entropy spans. An allowed word parts its string into stretches that are
    measured each, with a class and a span of its own, and strings without a digit have classes of
    their own; with ``thorough=False`` an allowed word suppresses its whole string, and
    strings without a digit are not measured. Null counts as empty, which has no finds: counts
    0 and empty lists. Repeated rows and null ids are returned as they come; an
    empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # Most texts have no match at all, so a plain search comes before the costlier extraction.
    # The look-behinds save time: a run of characters is tried from its start only.
    patterns = {
        "assign": ASSIGN,
        "access": ACCESS,
        "hex": r"(?<![0-9a-f])" + HEX,
        "entropy": r"(?<![A-Za-z0-9+/=_-])" + CANDIDATE,
    }
    text = F.col("text")
    found = {k: F.when(text.rlike(p), F.regexp_extract_all(text, F.lit(p), F.lit(0))) for k, p in patterns.items()}
    gaps = {f"{k}_gaps": F.when(text.rlike(p), F.split(text, p, -1)) for k, p in patterns.items()}
    values = F.when(text.rlike(ASSIGN), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    rows = rows.select("doc_id", values.alias("assign_values"), *[c.alias(k) for k, c in (found | gaps).items()])

    spans = {k: F.expr(_spans(k, i)) for i, k in enumerate(KINDS)}
    rows = rows.select("doc_id", "assign_values", *[c.alias(k) for k, c in spans.items()])
    long_values = F.expr(f"filter(assign, (x, i) -> length(assign_values[i]) >= {ASSIGN_CHARS})")
    least = _least_entropy("x.found", (), CLASSES + LETTERS) if thorough else _least_entropy("x.found")
    candidates = f"flatten(transform(entropy, y -> {_pieces('y')}))" if thorough else "entropy"
    measured = f"transform({candidates}, x -> named_struct('x', x, 'least', {least}))"
    windows = f"transform(filter({measured}, m -> m.least IS NOT NULL), m -> named_struct('x', m.x, 'part', {_dense_part('m.x.found', 'm.least')}))"
    dense = f"""transform(filter({windows}, m -> m.part.first IS NOT NULL), m -> named_struct(
        'start', m.x.start + m.part.first, 'kind', m.x.kind, 'end', m.x.start + m.part.last + {WINDOW}, 'found', m.x.found))"""
    rows = rows.select("doc_id", long_values.alias("assign"), "access", "hex", F.expr(dense).alias("entropy"))
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    rows = rows.withColumn("every", F.array_sort(F.concat("base", "entropy")))
    return rows.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.expr(_listed("base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(_listed("every")).alias("spans"),
        F.size("entropy").cast("bigint").alias("n_entropy"),
    )
