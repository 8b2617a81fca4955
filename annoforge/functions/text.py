"""Text, number and identity rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separators of row and frame fingerprints.
UNIT, LINE = "\x1f", "\n"
#: Texts that count as true, by variant.
TRUE_WORDS = {"queue": ("1", "true", "yes", "y"), "audit": ("true", "1", "yes")}


def stripped(c: Column) -> Column:
    """Without white space at either end; a null is empty."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^\s+|\s+$", "")


def lowered(c: Column) -> Column:
    return F.lower(stripped(c))


def underscored(c: Column) -> Column:
    """Lower case, blanks and hyphens as underscores."""
    return F.translate(lowered(c), " -", "__")


def truthy(c: Column, variant: str = "queue") -> Column:
    return lowered(c).isin(*TRUE_WORDS[variant])


def tri_state(c: Column) -> Column:
    """1, 0 or empty."""
    low = lowered(c)
    return F.when(low.isin("1", "true", "yes", "y"), "1").when(low.isin("0", "false", "no", "n"), "0").otherwise("")


def allowed(c: Column, choices: list[str]) -> Column:
    """The normalised value where it is a choice, else empty."""
    return F.when(underscored(c).isin(*choices), underscored(c)).otherwise("")


def with_note(notes: Column, note: str | Column) -> Column:
    """Notes with a note after a bar, once."""
    note = F.lit(note) if isinstance(note, str) else note
    old = stripped(notes)
    return F.when(old == "", note).when(F.contains(old, note), old).otherwise(F.concat(old, F.lit(" | "), note))


def sha1_id(*parts: Column, prefix: str = "") -> Column:
    """First 16 hex digits of the SHA-1 of the parts joined by bars."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.encode(joined, "UTF-8")), 1, 16))


def sha256_hex(c: Column) -> Column:
    """Upper-case hex of the SHA-256 of a text."""
    return F.upper(F.sha2(F.encode(c, "UTF-8"), 256))


def row_payload(*parts: Column) -> Column:
    return F.concat_ws(UNIT, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def row_fingerprint(*parts: Column) -> Column:
    return sha256_hex(row_payload(*parts))


def hex_digest(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9A-Fa-f]{64}$"), F.lit(False))


def percent(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.coalesce(F.bround(F.try_divide(F.lit(100.0) * part, whole), digits), F.lit(0.0))


def number_or_zero(c: Column) -> Column:
    v = F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), 0.0).otherwise(v)


def fixed(c: Column, digits: int = 6) -> Column:
    """Fixed digits of the exact binary value, ties to even, as printf gives them: 0.0015625 as a double is above that
    tie and becomes 0.001563. Rounding of the shortest digits, as bround and format_string do it, takes it for the tie.

    Twice the scaled value is a product with its rounding error (Dekker), so that its place beside an odd whole number,
    a tie, is known exactly. From 2^53 of that on the shortest digits are rounded."""
    x, scale = number_or_zero(c), 10**digits
    a, twice = F.abs(x), F.lit(float(2 * scale))
    split = 134217729.0  # 2^27 + 1
    high = lambda v: v * split - (v * split - v)
    q = float(2 * scale)
    q1 = q * split - (q * split - q)
    q2 = q - q1
    product = a * twice
    a1 = high(a)
    a2 = a - a1
    error = ((a1 * q1 - product) + a1 * q2 + a2 * q1) + a2 * q2
    whole = F.round(product).try_cast("bigint")
    beside = (product - whole) + error
    half = F.shiftright(whole, 1)
    up = (whole % 2 == 1) & ((beside > 0) | ((beside == 0) & (half % 2 == 1)))
    units = half + up.cast("bigint")
    places = F.lpad((units % scale).cast("string"), digits, "0")
    text = F.concat(F.when(x < 0, "-").otherwise(""), ((units - units % scale) / scale).cast("bigint").cast("string"), *([F.lit("."), places] if digits else []))
    return F.when(product < float(1 << 53), text).otherwise(F.format_string(f"%.{digits}f", F.bround(x, digits)))


def instant(c: Column, offset: str = "optional") -> Column:
    """Timestamp of an ISO text; null where it does not parse or lacks a required offset."""
    at = F.try_to_timestamp(c)
    if offset == "required":
        at = F.when(c.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), at)
    return at


def utc_seconds(epoch: Column) -> Column:
    """ISO text in UTC, whole seconds, with offset."""
    return F.concat(F.date_format(F.timestamp_seconds(F.floor(epoch)), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.translate(path, "\\", "/"), "/"), -1)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(base_name(path), r"[^.](\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]+$", "")


def safe_path(path: Column, forbidden: str = "test") -> Column:
    """Relative, not climbing, and without a part of the forbidden name."""
    parts = F.split(F.translate(path, "\\", "/"), "/")
    bad = F.exists(parts, lambda p: (p == "..") | (F.lower(p) == forbidden))
    return path.isNotNull() & (path != "") & ~path.startswith("/") & ~path.rlike("^[A-Za-z]:") & ~bad


def formula_like(c: Column) -> Column:
    return F.coalesce(c.startswith("="), F.lit(False))


def due(n: Column, interval: int) -> Column:
    """Whether a count is a positive multiple of the interval."""
    return (n > 0) & (n % interval == 0)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with keys in order."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def id_list(raw: Column) -> Column:
    """Sorted ids of a JSON array; null if it does not parse, holds a blank or a repeat."""
    ids = F.array_sort(F.from_json(raw, "array<string>"))
    good = ~F.exists(ids, lambda x: x.isNull() | (F.trim(x) == "")) & (F.size(ids) == F.size(F.array_distinct(ids)))
    return F.when(good, ids)


def box_record(raw: Column) -> Column:
    """Struct x1, y1, x2, y2 of a JSON object with exactly these keys; null otherwise."""
    box = F.from_json(raw, "x1 double, y1 double, x2 double, y2 double")
    keys = F.array_sort(F.json_object_keys(raw))
    whole = box["x1"].isNotNull() & box["y1"].isNotNull() & box["x2"].isNotNull() & box["y2"].isNotNull()
    return F.when((keys == F.array(*[F.lit(k) for k in ("x1", "x2", "y1", "y2")])) & whole, box)


def cosine_softmax(vector: Column, prototypes: list[list[float]], scale: float = 100.0) -> Column:
    """Probabilities of prototypes: softmax of scaled cosines of two normalised vectors."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    scores = []
    for p in prototypes:
        length = sum(v * v for v in p) ** 0.5
        unit = F.array(*[F.lit(v / length) for v in p])
        dot = F.aggregate(F.zip_with(vector, unit, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
        scores.append(dot / norm * scale)
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    parts = [F.exp(s - top) for s in scores]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.array(*[p / total for p in parts])


def needs_literal(c: Column) -> Column:
    """Whether a sheet would take a cell for a formula unless it is marked as text."""
    return F.coalesce(F.substring(c, 1, 1).isin("=", "+", "-", "@"), F.lit(False))


def literal(c: Column) -> Column:
    """Texts for cells, those that a sheet would take for formulas after the mark of a text."""
    return F.when(needs_literal(c), F.concat(F.lit("'"), c)).otherwise(F.coalesce(c, F.lit("")))


def scalar(c: Column, kind: str = "string") -> Column:
    """A value as text: null and NaN as blank, instants in UTC with offset, all else stripped. kind: string, double or timestamp."""
    if kind == "timestamp":
        at = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.coalesce(F.concat(F.regexp_replace(at, r"\.000000$", ""), F.lit("+00:00")), F.lit(""))
    if kind == "double":
        return F.when(c.isNull() | F.isnan(c), "").otherwise(c.cast("string"))
    return stripped(c)


def strict_number(c: Column, integer: bool = False, positive: bool = False) -> Column:
    """Struct (value, code) of a text as a number; the code says why the value is null: not_numeric, not_finite, not_positive."""
    value = stripped(c).try_cast("bigint" if integer else "double")
    code = F.when(value.isNull() | (F.lit(integer) & ~stripped(c).rlike(r"^[+-]?[0-9]+$")), "not_numeric")
    if not integer:
        code = code.when(F.isnan(value) | (F.abs(value) == float("inf")), "not_finite")
    if positive:
        code = code.when(value <= 0, "not_positive")
    code = code.otherwise("")
    return F.struct(F.when(code == "", value).alias("value"), code.alias("code"))


def json_checksum(**fields: Column) -> Column:
    """SHA-256 of the canonical JSON."""
    return F.sha2(F.encode(canonical_json(**fields), "UTF-8"), 256)


def first_column(columns: list[str], wanted: list[str]) -> str | None:
    """The first of the wanted names that is a column."""
    return next((w for w in wanted if w in columns), None)
