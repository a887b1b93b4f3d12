"""Small tables with the cases that every operator must stand."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators give to columns of their own while they work.
INNER = ("n_docs", "_held", "_source", "_steps", "_u", "_count", "_score", "_own", "_keep", "_digest", "_kept", "_hot", "_total", "rate", "size")
# Columns of the input whose names operators use themselves.
CLASHING = "tag bigint, part int, rank int, length bigint, digest string, component_id bigint, n bigint, slice int"


def words(seed: int, count: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}é"[: rng.randrange(2, 6)] for _ in range(count)]


def rows() -> list[tuple]:
    """Near and exact copies, chains, shared passages, nulls, empty texts, separators, ties, long and repeated rows."""
    base = words(1, 60)
    near = [" ".join(base[:k] + [f"x{k}"] + base[k + 1 :]) for k in (2, 57, 58)]
    # Each is close to the one before, the ends are not close to each other.
    chain = [" ".join(words(2, 80)[k : k + 60]) for k in (0, 3, 6, 9)]
    passage = " ".join(words(3, 40))
    shared = [f"{' '.join(words(10 + k, 30))} {passage} {' '.join(words(40 + k, 30))}" for k in range(5)]
    texts = [
        " ".join(base), *near, " ".join(base), *chain, *shared, passage, None, "", " \n\t ", None, "one two", "ONE  two",
        "one two three four", "a b c d e f g", "A b\nc d e f g", " ".join(words(5, 6000)), "x" * 49, "y" * 50, "y" * 50, "y" * 70,
        "zé" * 40, "zé" * 40 + "!", "\u0000nul \u0000bytes " * 6, "Über 'Quoted' don't é! #$% 12 3.4 <tag>",
    ]
    out = [(k, t, "en" if k % 3 else None, ["a", "b", None][k % 3], len(t or "")) for k, t in enumerate(texts)]
    out += [(7, texts[7], "en", "a", 1), (7, texts[7], "en", "a", 1), (-3, "negative id text", None, "c", None)]
    return out + [(None, " ".join(base), "en", "a", 3), (None, None, None, None, None), (900, texts[5], "de", "b", 0)]


def documents(spark, with_clashes: bool = False, empty: bool = False):
    df = spark.createDataFrame([] if empty else rows(), DOCS).repartition(3)
    if with_clashes:
        for column in CLASHING.split(", "):
            name, kind = column.split()
            df = df.selectExpr("*", f"CAST(n_chars AS {kind}) AS {name}")
    return df


def as_rows(df, *columns: str) -> list[tuple]:
    found = [tuple(row[c] for c in columns) for row in df.collect()]
    return sorted(found, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])
