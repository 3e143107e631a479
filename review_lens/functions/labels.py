"""The label grammar as native expressions.

A label is a `;`-separated list of parts, each `{ASPECT#Sentiment}` or
`{OTHERS}`. Parts that do not open with a brace, or that hold more than one
`#`, are ignored; a later part for the same aspect replaces an earlier one.

Expressions over all aspects are long, so they are written as SQL text: one
parse is much quicker to set up than hundreds of single column calls.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_lens.schema import ASPECTS, OTHERS, RATED_ASPECTS, SENTIMENT_CODES, SENTIMENT_NAMES

_BLANKS = r"' \t\n\r\f\u000b'"
# `{`, then any text with a single `#`.
_PAIR = r"r'(?s)^\{[^#]*#[^#]*\z'"
_PLAIN_OTHERS = "{" + OTHERS + "}"

# A label as one long: three bits per aspect, of which the upper one says that
# the aspect is mentioned and the other two hold its code. Bit 60 marks a
# well-formed part about an aspect outside the list.
_UNITS = {aspect: 1 << (3 * j) for j, aspect in enumerate(ASPECTS)}
_MENTIONS = sum(4 * unit for unit in _UNITS.values())
_UNLISTED = 1 << 60


def quoted(column: str) -> str:
    return f"`{column}`"


def _lookup(table: dict, key: str) -> str:
    literals = ", ".join(f"'{k}', {v}L" for k, v in table.items())
    return f"try_element_at(map({literals}), {key})"


def _common_parts() -> dict:
    """The parts that labels are normally made of, with their bits."""
    table = {
        "{" + aspect + "#" + sentiment + "}": _UNITS[aspect] * (4 + value)
        for aspect in RATED_ASPECTS
        for sentiment, value in SENTIMENT_CODES.items()
    }
    table[_PLAIN_OTHERS] = _UNITS[OTHERS] * 5
    return table


def _part_bits(part: str) -> str:
    """Bits of one part: a table look-up, or a closer look at an unusual one."""
    aspect = f"substring_index(btrim({part}, '{{}}'), '#', 1)"
    sentiment = f"substring_index(btrim({part}, '{{}}'), '#', -1)"
    value = f"if({aspect} = '{OTHERS}', 1L, coalesce({_lookup(SENTIMENT_CODES, sentiment)}, 0L))"
    unusual = f"coalesce({_lookup(_UNITS, aspect)} * (4L + {value}), {_UNLISTED}L)"
    return f"coalesce({_lookup(_common_parts(), part)}, if({part} rlike {_PAIR}, {unusual}, 0L))"


def _pieces(label: str) -> str:
    return f"split(btrim(coalesce({label}, ''), {_BLANKS}), ';')"


def label_bits(label="label") -> Column:
    """A label as one long; 0 when it holds no well-formed part.

    One pass over the few parts that a label has, instead of one search per
    aspect. Select it under a name before taking it apart with `mentioned` and
    `code`, so that it is worked out once per row.
    """
    bits = f"transform({_pieces(quoted(label))}, p -> {_part_bits('p')})"
    # All three bits of the aspect that the later part mentions make way for it.
    group = f"(shiftright(part & {_MENTIONS}L, 2) * 7L)"
    return F.expr(f"aggregate({bits}, 0L, (bits, part) -> (bits & ~{group}) | part)")


def mentioned(bits: str, aspect: str) -> str:
    return f"(({bits} & {4 * _UNITS[aspect]}L) <> 0L)"


def code(bits: str, aspect: str) -> str:
    """Code of an aspect, 0 when the label does not mention it."""
    return f"cast(shiftright({bits}, {3 * ASPECTS.index(aspect)}) & 3L AS INT)"


def maybe_labelled(label="label") -> Column:
    """A cheap test that every label with a well-formed part passes."""
    return F.contains(F.col(label), F.lit("{"))


def decoded(rows: DataFrame, label="label", suffix="") -> DataFrame:
    """Add the codes of a label, one int column per aspect, named after it."""
    bits = rows.select("*", label_bits(label).alias("_bits"))
    codes = [f"{code('_bits', a)} AS {quoted(a + suffix)}" for a in ASPECTS]
    return bits.selectExpr(*[quoted(c) for c in rows.columns], *codes)


def aspect_array(suffix="") -> Column:
    """Pack one code column per aspect into an int array, in aspect order."""
    packed = ", ".join(f"cast({quoted(a + suffix)} AS INT)" for a in ASPECTS)
    return F.expr(f"array({packed})")


def encode(suffix="") -> Column:
    """One code column per aspect back to a label; '' when every aspect is absent."""
    pieces = []
    for aspect in ASPECTS:
        column = f"cast({quoted(aspect + suffix)} AS INT)"
        if aspect == OTHERS:
            pieces.append(f"CASE WHEN {column} <> 0 THEN '{_PLAIN_OTHERS};' END")
            continue
        cases = " ".join(
            f"WHEN {value} THEN '{{{aspect}#{name}}};'" for value, name in SENTIMENT_NAMES.items()
        )
        pieces.append(f"CASE {column} {cases} END")
    return F.expr(f"concat_ws('', {', '.join(pieces)})")


def parts(label="label") -> Column:
    """The well-formed parts of a label as an array, in order."""
    return F.expr(
        f"filter({_pieces(quoted(label))}, p -> p = '{_PLAIN_OTHERS}' OR p rlike {_PAIR})"
    )


def part_body(part: Column) -> Column:
    """A part without its braces."""
    return F.btrim(part, F.lit("{}"))


def sentiment_code(aspect="aspect", sentiment="sentiment") -> Column:
    """Code of a split part; OTHERS is a mere flag, unknown sentiments are 0."""
    known = f"cast(coalesce({_lookup(SENTIMENT_CODES, sentiment)}, 0L) AS INT)"
    return F.expr(f"if({aspect} = '{OTHERS}', 1, {known})")
