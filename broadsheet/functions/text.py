"""Column functions on text: terms, keyword hashes, glued keys."""

from pyspark.sql import Column, functions as F

# a term is a maximal run of letters and digits
TERM_PATTERN = r"([\p{L}\p{N}]+)"
HAN_RUN_PATTERN = r"(\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+)"


def terms(text: Column) -> Column:
    """Lower-case letter/digit runs of a text, in reading order."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN))


def terms_with_bigrams(text: Column) -> Column:
    """Like :func:`terms`, but Han runs are cut in overlapping pairs."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(HAN_RUN_PATTERN))

    def pairs(run: Column) -> Column:
        positions = F.sequence(F.lit(1), F.length(run) - 1)
        return F.when(
            run.rlike(r"^\p{IsHan}{2,}$"),
            F.transform(positions, lambda i: F.substring(run, i, F.lit(2))),
        ).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pairs))


#: Ways to cut a text, by the name that a trained model keeps.
SPLITS = {"terms": terms, "bigrams": terms_with_bigrams}


def keyword_hash(keyword: Column) -> Column:
    return F.md5(F.trim(keyword))


def glue_key(*parts: Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[p.cast("string") for p in parts])


def key_part(key: Column, position: int, sep: str = "|") -> Column:
    return F.split_part(key, F.lit(sep), F.lit(position))


def one_line(text: Column) -> Column:
    """A text without the characters that separate fields and records."""
    return F.regexp_replace(text, "[\t\r\n]+", " ")
