import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *[T.StructField(x, T.StringType()) for x in ("row", "words", "label", "token", "vertex", "bytes", "gone", "held")],
    ]
)

VOICES = {
    "en": "the of and to in a is that it for was on with as be at by this are from thing water under house".split(),
    "fr": "de la le les et des en un une que du est pour qui dans par au pas sur avec maison chanson étoile".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    own = VOICES[lang]
    out = [rng.choice(own) if rng.random() < 0.6 else "".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(3, 9))) for _ in range(words)]
    return "".join(w + ("\n" if rng.random() < 0.05 else " ") for w in out).strip()


def build() -> list[tuple[int | None, str | None, str | None]]:
    rng = random.Random(7)
    rows: list[tuple[int | None, str | None, str | None]] = []
    base = {lang: [prose(rng, lang, n) for n in (120, 300, 40)] for lang in VOICES}
    passage = prose(rng, "en", 60)
    for lang, texts in base.items():
        for text in texts:
            words = text.split(" ")
            near = words.copy()
            near[len(near) // 2] = "changed"
            far = [w if k % 9 else "other" + str(k) for k, w in enumerate(words)]
            for t in (text, text, " ".join(near), " ".join(far), text.upper()):
                rows.append((len(rows), t, lang))
            rows.append((len(rows), prose(rng, lang, 30) + " " + passage + " " + prose(rng, lang, 30), lang))
    rows += [(100 + k, t, "en") for k, t in enumerate((None, "", " \n ", "...", "one", "one two", "One TWO", "a b c", "é"))]
    rows.append((rows[0][0], rows[0][1], None))  # a repeated row
    rows.append((None, base["en"][0], "en"))
    rows.append((None, None, None))
    rows.append((500, "ab " * 3_000, "en"))  # long, and all alike
    rows.append((501, prose(rng, "en", 9_000), "en"))
    rows.append((502, "x" * 5_000, None))
    rows.append((503, "漢字 かな 🙂 " * 60, "ja"))
    rows.append((504, "Mail a.b@c.org, b@d.co.uk; 10.0.0.1 and 999.1.1.1; 4111 1111 1111 1111; +49 (30) 1234-567\n" * 2, "en"))
    rows.append((505, "<|endoftext|> it's  <|endoftext|>\n\n  we'll\t <s> ▁▁ a ▁ b", "en"))
    return rows


@pytest.fixture(scope="session")
def rows():
    return build()


@pytest.fixture(scope="session")
def docs(spark, rows):
    filled = [(i, t, lang, "src0", None, *["clash"] * 8) for i, t, lang in rows]
    return spark.createDataFrame(filled, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
