"""Fill-in-middle: texts cut at unit borders, their parts reordered behind markers. DataFrame functions only, one pass, no shuffle.

A delimiter marks where units end: it is escaped where the text itself holds it, put after every unit by one regexp_replace,
counted, and substring_index then takes the first, middle or last units by rank; the delimiters go and the escapes are undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A unit is a line with its line feed, or what is left after the last one.
LINES = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: The delimiter, the escape character, and how each is written in an escaped text.
MARK, ESCAPE = "\x1f", "\x1b"
ESCAPED_MARK, ESCAPED_ESCAPE = ESCAPE + "d", ESCAPE + "e"

RESULT = ("n", "form", "prefix", "middle", "suffix", "output")


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def _escape(text: Column) -> Column:
    return _replace(_replace(text, ESCAPE, ESCAPED_ESCAPE), MARK, ESCAPED_MARK)


def _plain(units: Column) -> Column:
    """A text again of marked units: inserted delimiters go first, since no escaped text holds one."""
    return _replace(_replace(_replace(units, MARK, ""), ESCAPED_MARK, MARK), ESCAPED_ESCAPE, ESCAPE)


def _first(units: Column, count: Column) -> Column:
    return F.call_function("substring_index", units, F.lit(MARK), count.cast("int"))


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four integers of 32 bits from the sha256 of seed:doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _before(text: Column, marker: str) -> Column:
    return F.substring_index(text, marker, 1)


def _after(text: Column, marker: str) -> Column:
    return F.substring_index(text, marker, -1)


def restore(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of. No part holds a marker, so the first of each kind is the one that was put there."""
    psm = F.concat(F.substr(_before(output, SUFFIX), F.lit(len(PREFIX) + 1)), _after(output, MIDDLE), _before(_after(output, SUFFIX), MIDDLE))
    spm = F.concat(_before(_after(output, PREFIX), MIDDLE), _after(output, MIDDLE), F.substr(_before(output, PREFIX), F.lit(len(SUFFIX) + 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINES, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, the carried columns, n (units), form, prefix, middle, suffix, output.

    The text is cut after two ranks between 0 and n, drawn by a hash of seed and doc_id, into prefix, middle and suffix, any of which may
    be empty. output is, by another draw, psm (prefix, suffix, middle) or, in spm of 100 cases, spm (suffix, prefix, middle), each part
    behind its marker. It is the text itself (plain; the parts are null) if the text is empty or holds a marker, which could not
    be told from those put in, and in 100 - rate of 100 cases. unit is a regular expression that matches the whole text piece
    by piece and treats the two control characters of the escapes, and d and e, as it treats any letter.

    A null text counts as empty; a null doc_id draws as an empty string; rows that share an id are cut at the same draws. Texts of any
    length are handled in time proportional to it. Columns of docs that are not carried are left out; a carried column with the
    name of a result is refused.
    """
    if clash := set(carry) & {"doc_id", *RESULT}:
        raise ValueError(f"carried columns have names of results: {sorted(clash)}")
    keep = [F.col(c).alias(f"_carry_{i}") for i, c in enumerate(carry)]
    df = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("units", F.regexp_replace(_escape(F.col("text")), unit, "$0" + MARK))
    df = df.withColumn("n", (F.octet_length("units") - F.octet_length(_replace(F.col("units"), MARK, ""))).cast("long"))
    df = df.withColumns({f"h{k}": h for k, h in enumerate(draws(F.col("doc_id"), seed), 1)})
    one, other = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    df = df.withColumns({"a": F.least(one, other), "b": F.greatest(one, other)})
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= rate)
    df = df.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm"))
    units, n, a, b = (F.col(c) for c in ("units", "n", "a", "b"))
    # A delimiter follows the last unit too, so the last k units are the last k + 1 pieces.
    parts = {"prefix": _first(units, a), "middle": _first(_first(units, b), a - b), "suffix": _first(units, b - n - 1)}
    df = df.withColumns({k: F.when(F.col("form") != "plain", _plain(v)) for k, v in parts.items()})
    p, s, m = (F.concat(F.lit(marker), F.col(c)) for marker, c in ((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle")))
    output = F.when(F.col("form") == "psm", F.concat(p, s, m)).when(F.col("form") == "spm", F.concat(s, p, m)).otherwise(F.col("text"))
    df = df.withColumn("output", output)
    return df.select("doc_id", *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)), *RESULT)


def digest(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the sha256 of the output and of the text restored from it."""
    df = fill_in_middle(docs, seed, rate, spm).withColumn("restored", restore(F.col("output"), F.col("form")))
    return df.select(
        "doc_id", "n", "form", F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
