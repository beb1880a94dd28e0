"""Small text and array expressions the operators are composed of."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import patterns as P


def named(name: str) -> Column:
    """The column called exactly ``name``, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(text: Column) -> Column:
    """Trim every kind of whitespace; the built-in trim knows blanks only."""
    return F.trim(text, F.lit(P.WS_CHARS))


def is_blank(text: Column) -> Column:
    """Nothing but whitespace; stops at the first other character."""
    return ~text.rlike(f"[^{P.WS}]")


def keep_rows(df: DataFrame, condition: Callable[[Column], Column]) -> DataFrame:
    """Rows whose struct of columns meets ``condition``, each column computed once.

    A filter would be pushed below the projection that computes its columns, and the
    optimizer would put their whole expressions in place of each reference. A
    generator is no filter.
    """
    row = F.struct(*[named(c) for c in df.columns])
    return df.select(F.inline(F.filter(F.array(row), condition)))


def parse_time(text: Column) -> Column:
    """A timestamp from ISO text, or from year/month/day or month/day/year; null for
    anything else."""
    dashed = F.regexp_replace(text, r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    dashed = F.regexp_replace(dashed, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    return F.try_to_timestamp(dashed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside a lambda, an outer expression is evaluated again for each element; a
    lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return F.filter(F.split(text, P.NOT_WORD), lambda w: w != "")


def _cut(text: Column, pattern: str, without_email: str) -> Column:
    return F.when(
        text.contains("@"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    ).otherwise(F.regexp_extract_all(text, F.lit(without_email), F.lit(0)))


def pieces(text: Column) -> Column:
    """Lossless cut into words, numbers, addresses, blanks and single characters."""
    return _cut(text, P.PIECE, P.PIECE_NO_EMAIL)


def tokens(text: Column) -> Column:
    """The pieces that are not blank."""
    return _cut(text, P.TOKEN, P.TOKEN_NO_EMAIL)


def tokens_of(cut: Column) -> Column:
    """The same from the pieces of a text."""
    return F.filter(cut, is_token)


def token_spans(text: Column) -> Column:
    """Array of (token, start, end) of the pieces that are not blank; offsets count code points, end
    exclusive. They are running totals of the pieces' lengths, since the cut loses nothing."""

    def spans(cut: Column) -> Column:
        ends = running_totals(F.transform(cut, F.length))
        placed = F.zip_with(
            cut, ends, lambda p, end: F.struct(p.alias("token"), (end - F.length(p)).alias("start"), end.alias("end"))
        )
        return F.filter(placed, lambda t: is_token(t["token"]))

    return F.when(text.isNotNull(), let(pieces(text), spans))


# Comparisons of the first byte. They spare most pieces a regular expression.


def starts_letter(piece: Column) -> Column:
    """Starts with an ASCII letter."""
    return ((piece >= "a") & (piece < "{")) | ((piece >= "A") & (piece < "["))


def starts_digit(piece: Column) -> Column:
    """Starts with an ASCII digit."""
    return (piece >= "0") & (piece < ":")


def starts_ascii(piece: Column) -> Column:
    """Starts with a printable ASCII character other than the blank."""
    return (piece >= "!") & (piece < "\x7f")


def is_token(piece: Column) -> Column:
    """Not blank. Most blank pieces are a single blank."""
    return (piece != " ") & (starts_ascii(piece) | ~piece.rlike(P.BLANK_PIECE))


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, P.SENTENCE_END, "$1\u0001")
    return F.filter(
        F.transform(F.split(marked, "\u0001"), strip),
        lambda s: s != "",
    )


def scan(values: Column, zero: Column, step: Callable, state_type: str) -> Column:
    """The states of a left fold after each element.

    Appending to an array copies it, so a plain fold that keeps its states costs
    the square of the array's length. Folding over blocks of sqrt(n) elements and
    flattening at the end costs n * sqrt(n), which keeps one very long text from
    holding up its task.
    """

    def fold_block(state: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(
                state.alias("last"),
                F.array().cast(f"array<{state_type}>").alias("states"),
            ),
            lambda acc, x: let(
                step(acc["last"], x).cast(state_type),
                lambda s: F.struct(
                    s.alias("last"), F.array_append(acc["states"], s).alias("states")
                ),
            ),
        )

    def fold_all(array: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(array))).cast("int")
        count = F.ceil(F.size(array) / width).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(1), count),
            lambda b: F.slice(array, (b - 1) * width + 1, width),
        )
        folded = F.aggregate(
            blocks,
            F.struct(
                zero.cast(state_type).alias("last"),
                F.array().cast(f"array<array<{state_type}>>").alias("blocks"),
            ),
            lambda acc, block: let(
                fold_block(acc["last"], block),
                lambda r: F.struct(
                    r["last"].alias("last"),
                    F.array_append(acc["blocks"], r["states"]).alias("blocks"),
                ),
            ),
        )
        return F.flatten(folded["blocks"])

    return let(
        values,
        lambda a: F.when(F.size(a) > 0, fold_all(a)).otherwise(
            F.array().cast(f"array<{state_type}>")
        ),
    )


# Elements whose totals are found by doubling; a power of two.
_TOTALS_WIDTH = 32


def running_totals(numbers: Column) -> Column:
    """The sum of an array of ints up to each element.

    Inside each 32 elements the sums double their reach in five passes, without a state that is
    copied; only the totals of these blocks are folded by ``scan``.
    """

    def reach(sums: Column, step: int) -> Column:
        return F.transform(
            sums,
            lambda s, i: F.when(i.bitwiseAND(F.lit(_TOTALS_WIDTH - 1)) >= step, s + F.get(sums, i - step)).otherwise(s),
        )

    def within(sums: Column, step: int) -> Column:
        if step == _TOTALS_WIDTH:
            return let(sums, across)
        return let(sums, lambda s: within(reach(s, step), 2 * step))

    def across(sums: Column) -> Column:
        blocks = F.sequence(F.lit(1), (F.size(sums) / _TOTALS_WIDTH).cast("int"))
        totals = F.transform(blocks, lambda b: F.get(sums, b * _TOTALS_WIDTH - 1))
        return F.when(F.size(sums) <= _TOTALS_WIDTH, sums).otherwise(
            let(
                scan(totals, F.lit(0), lambda end, t: end + t, "int"),
                lambda before: F.transform(
                    sums,
                    lambda s, i: F.when(i < _TOTALS_WIDTH, s).otherwise(
                        s + F.get(before, F.shiftright(i, _TOTALS_WIDTH.bit_length() - 1) - 1)
                    ),
                ),
            )
        )

    return within(numbers, 1)


def distinct_ignoring_case(texts: Column) -> Column:
    """Drop later texts that differ from an earlier one in case only; keep order.

    Sorting brings equal texts together, so the cost is n log n; those that are the same are told by
    their hashes before.
    """

    def keep_first(ranked: Column) -> Column:
        firsts = F.filter(
            ranked,
            lambda e, i: (i == 0) | (F.get(ranked, i - 1)["folded"] != e["folded"]),
        )
        in_order = F.sort_array(
            F.transform(firsts, lambda e: F.struct(e["at"].alias("at"), e["text"].alias("text")))
        )
        return F.transform(in_order, lambda e: e["text"])

    ranked = F.sort_array(
        F.transform(
            F.array_distinct(texts),
            lambda t, i: F.struct(F.lower(t).alias("folded"), i.alias("at"), t.alias("text")),
        )
    )
    return let(ranked, keep_first)


def two_decimals(value: Column) -> Column:
    """A share in [0, 1] with two decimals, rounded as IEEE printing does.

    ``format_string`` rounds the shortest decimal form half up; reports need the
    double's exact value rounded half to even. Scaling by a power of two is exact.
    """
    unit = 1 << 60
    scaled = (value * F.lit(float(unit))).cast("bigint").cast("decimal(20,0)")

    def fmt(v: Column) -> Column:
        hundredfold = v * F.lit(100).cast("decimal(3,0)")
        whole = F.floor(hundredfold / F.lit(unit).cast("decimal(20,0)")).cast("bigint")

        def rounded(w: Column) -> Column:
            rest = hundredfold - w.cast("decimal(20,0)") * F.lit(unit).cast("decimal(20,0)")
            half = F.lit(unit // 2).cast("decimal(20,0)")
            up = (rest > half) | ((rest == half) & (w % 2 == 1))
            return w + up.cast("bigint")

        return let(
            let(whole, rounded),
            lambda c: F.format_string("%d.%02d", F.floor(c / 100).cast("bigint"), c % 100),
        )

    return let(scaled, fmt)
