"""Hash JSON by meaning: key order and spacing must not matter, array order must."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# One piece per match: a \uXXXX escape, another escape, a run of plain ASCII, or another character.
_PIECES = r"(?s)\\u[0-9A-Fa-f]{4}|\\.|[\x20-\x7E&&[^\\]]+|."


def _unicode_escape(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _ascii_piece(piece: Column) -> Column:
    """Piece with everything beyond ASCII written as lower-case ``\\uXXXX`` (UTF-16 pairs)."""
    code = F.ascii(piece)
    offset = code - 0x10000
    high = F.shiftright(offset, 10) + 0xD800
    low = offset.bitwiseAND(0x3FF) + 0xDC00
    return (
        F.when(piece.startswith("\\u"), F.lower(piece))
        .when(code < 0x7F, piece)
        .when(code < 0x10000, _unicode_escape(code))
        .otherwise(F.concat(_unicode_escape(high), _unicode_escape(low)))
    )


# Numbers whose text the parser would change: exponents, trailing zeros of a fraction, fractions of more
# digits than a double keeps or with many leading zeros, and integers beyond 38 digits.
_UNFAITHFUL = (
    r"[0-9.][eE]|\.[0-9]*0(?![0-9])|(?=[0-9.]{17})[0-9]+\.[0-9]|[0-9]\.[0-9.]{15}"
    r"|(?<![0-9])0\.0000|[0-9]{39}"
)


def _keeps_numbers(document: Column) -> Column:
    """Whether every number outside strings is written back as it is."""
    bare = F.regexp_replace(F.regexp_replace(document, r"(?s)\\.", ""), r'"[^"]*"', '""')
    return ~bare.rlike(_UNFAITHFUL)


# Tokens of a JSON text: a string, a number, or what lies between them.
_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?[0-9][0-9.eE+\-]*+|[^"0-9\-]+|-'
# The form a double has as text: sign, digits, fraction, power of ten.
_DOUBLE = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]\+?(-?[0-9]+))?$"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _shortest_double(text: Column) -> Column:
    """A double as its shortest digits: positional from 1e-4 up to below 1e16, else with a signed power of two digits at least.

    It always reads back as the same double; between 1e16 and 9e18 its digits come from the whole number itself.
    """

    def shorter(value: Column, plain: Column, digits: int) -> Column:
        """The engine's own text is not always the shortest: it has two digits at least, and some large numbers get one too many."""
        candidate = F.format_string(f"%.{digits - 1}e", value)
        if digits > 1:  # a large number is a whole one, whose own digits are rounded
            large = F.abs(F.when(F.abs(value).between(1e16, 9e18), value).cast("long"))
            cut = F.length(large.cast("string")) - digits
            step = F.pow(F.lit(10), F.greatest(cut, F.lit(0))).cast("long")
            rounded = F.call_function("div", large + F.call_function("div", step, F.lit(2)), step).cast("string")
            whole = F.concat(F.when(value < 0, "-").otherwise(""), rounded, F.lit("e+"), F.greatest(cut, F.lit(0)).cast("string"))
            candidate = F.coalesce(whole, candidate)
        longer = F.length(F.regexp_replace(plain, "[Ee].*$|[-.]", "")) > digits
        return F.when(longer & (candidate.cast("double") == value), candidate).otherwise(plain)

    def chosen(value: Column) -> Column:
        text = shorter(value, value.cast("string"), 17)
        for digits in (16, 15, 1):
            text = _let(text, lambda t, n=digits: shorter(value, t, n))
        return text

    return _let(text.cast("double"), lambda value: _let(chosen(value), _laid_out))


def _laid_out(plain: Column) -> Column:
    sign, whole, rest = (F.regexp_extract(plain, _DOUBLE, i) for i in (1, 2, 3))
    power = F.coalesce(F.regexp_extract(plain, _DOUBLE, 4).try_cast("int"), F.lit(0))

    def of_digits(d: Column) -> Column:
        digits, point, n = d["digits"], d["point"], F.length(d["digits"])
        size = F.abs(point - 1).cast("string")
        fraction = F.when(n > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), n))).otherwise("")
        scientific = F.concat(
            F.substring(digits, 1, 1), fraction, F.when(point < 1, "e-").otherwise("e+"),
            F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size),
        )
        positional = (
            F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
            .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
            .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, n)))
        )
        written = F.when(digits == "", F.lit("0.0")).when((point > -4) & (point <= 16), positional).otherwise(scientific)
        return F.concat(d["sign"], written)

    def parts(p: Column) -> Column:
        bare = F.regexp_replace(p["every"], "^0+", "")
        return F.struct(
            p["sign"].alias("sign"),
            F.regexp_replace(bare, "0+$", "").alias("digits"),
            # digits before the point
            (p["whole"] + p["power"] - F.length(p["every"]) + F.length(bare)).alias("point"),
        )

    read = F.struct(sign.alias("sign"), F.concat(whole, rest).alias("every"), F.length(whole).alias("whole"), power.alias("power"))
    return F.when(plain.endswith("Infinity"), plain).otherwise(_let(read, lambda p: _let(parts(p), of_digits)))


def _number(text: Column) -> Column:
    """A number as it is dumped: integers digit by digit, others as doubles."""
    return F.when(text.rlike("[.eE]"), _shortest_double(text)).when(text == "-0", "0").otherwise(text)


def _exact_json(document: Column) -> Column:
    """Key-sorted compact JSON through Variant, with numbers travelling as text.

    Every string gets a leading ``s`` and every number becomes a string with a leading ``n``; the order of keys stays
    the same, and both marks are taken off again.
    """
    number = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
    marked = F.transform(
        F.regexp_extract_all(document, F.lit("(?s)" + _TOKENS), F.lit(0)),
        lambda t: F.when(t.startswith('"'), F.concat(F.lit('"s'), F.substring(t, F.lit(2), F.length(t))))
        .when(t.rlike(number), F.concat(F.lit('"n'), t, F.lit('"')))
        .otherwise(t),
    )
    sorted_text = F.to_json(F.try_parse_json(F.array_join(marked, "")))
    unmarked = F.transform(
        F.regexp_extract_all(sorted_text, F.lit("(?s)" + _TOKENS), F.lit(0)),
        lambda t: F.when(t.startswith('"s'), F.concat(F.lit('"'), F.substring(t, F.lit(3), F.length(t))))
        .when(t.startswith('"n'), _number(F.substring(t, F.lit(3), F.length(t) - 3)))
        .otherwise(t),
    )
    return F.array_join(unmarked, "")


def canonical_json(document: Column) -> Column:
    """Key-sorted compact JSON in pure ASCII; NULL for text that is not JSON.

    Variant keeps objects key-sorted and keeps explicit nulls, so no schema is needed. Numbers it would not write back as they
    are go through it as text: integers of any length keep their digits, others are doubles in their
    shortest form. Of a repeated key the last value counts if the session lets Variant take it (``spark.sql.variant.allowDuplicateKeys``, which
    :data:`sievework.session.SETTINGS` turns on); else such a document gives NULL.
    """
    compact = F.when(_keeps_numbers(document), F.to_json(F.try_parse_json(document))).otherwise(_exact_json(document))
    pieces = F.regexp_extract_all(compact, F.lit(_PIECES), F.lit(0))
    return F.array_join(F.transform(pieces, _ascii_piece), "")


# Hashing documents costs many times what reading them does: about so many short ones are a task's share (``spread_rows``).
HASHED_ROWS = 20_000


def canonical_hash(document: Column) -> Column:
    """SHA-256 of :func:`canonical_json`."""
    return F.sha2(canonical_json(document), 256)
