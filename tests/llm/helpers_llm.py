"""Small tables for the tests of the training-data operators."""

import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def documents(spark, texts, lang="en", source="s", start=0):
    rows = [(start + i, t, lang, source, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df, names):
    """df with extra columns of names that operators use themselves."""
    return df.withColumns({n: F.lit(f"extra {n}") for n in names if n not in df.columns})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, size=5):
    w = words(lowered(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def bare_words(text):
    return words(re.sub(r"[!-/:-@\[-`{-~]", "", lowered(text)))
