"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from tests.compare import compare, duck
from tests.llm import plain
from tidemark.llm import personal_data, quality_rules
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_language_accuracy(spark):
    got = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.01").filter("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    joined = got.join(labels, "doc_id")
    assert joined.filter("lang = lang_pred").count() >= 0.98 * joined.count()


def test_pipeline_against_plain(spark, docs, rows, tmp_path):
    import sentencepiece

    text = rows[6][1]
    items = [(1, text), (2, " ".join(text.split()[3:9])), (3, None)]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*docs.columns, "ids", "n_tokens"]

    left = [(r.doc_id, r.text) for r in quality_rules.judge(docs).filter("kept").select("doc_id").join(docs, "doc_id").distinct().collect()]
    left += [r[:2] for r in rows if r[0] is None and r[1]]
    named = plain.components([(10**9 if i is None else i, t) for i, t in left])
    first: dict = {}
    for (doc_id, own), (_, name) in zip(left, named, strict=True):
        if (10**9 if doc_id is None else doc_id) == name:
            first.setdefault(name, (doc_id, own))
    left = list(first.values())
    hit = plain.contamination([t for _, t in left], items)
    left = [row for row, found in zip(left, hit, strict=True) if not found[3]]
    assert 3 < len(left) < len(rows)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    masked = [(i, personal_data.mask(t, plain.pattern_spans(t))) for i, t in left]
    expected = [(i, t, len(t), tuple(library.encode(t, add_eos=True))) for i, t in masked]
    assert Counter((r.doc_id, r.text, r.n_chars, tuple(r.ids)) for r in got.collect()) == Counter(expected)


def test_pipeline_stages_keep_the_columns(spark, docs, no_docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, no_docs, SF)
        assert out.columns == no_docs.columns
        assert out.count() == 0


def test_pipeline_drops_near_copies_of_five_words(spark):
    """One changed word in 50 leaves 5-word Jaccard at 0.8 or more, 3-word Jaccard below 0.9."""
    rows, far = [], []
    for k in range(6):
        words = [f"w{k}x{i}" for i in range(400 + 100 * k)]
        near = [w if i % 50 != 25 else f"{w}new" for i, w in enumerate(words)]
        other = [w if i % 20 != 10 else f"{w}new" for i, w in enumerate(words)]
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(near)), (3 * k + 2, " ".join(other))]
        far.append(3 * k + 2)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, frame, "")
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    for k in range(0, len(rows), 3):
        assert len(sets[k] & sets[k + 1]) >= 0.8 * len(sets[k] | sets[k + 1])
        assert len(sets[k] & sets[k + 2]) < 0.8 * len(sets[k] | sets[k + 2])
    assert sorted(r.doc_id for r in got.collect()) == sorted([*range(0, len(rows), 3), *far])


def test_pipeline_keeps_texts_that_share_an_id(spark, tmp_path):
    """Rows are known by id and text: a copy of one text takes away that text alone."""
    words = {name: " ".join(f"{name}{i}" for i in range(60)) for name in "abcd"}
    rows = [(1, words["a"]), (2, words["b"]), (2, words["c"]), (3, words["a"]), (3, words["d"]), (None, words["d"]), (4, None), (4, "")]
    frame = spark.createDataFrame([*rows, rows[1], rows[1]], "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, frame, "")
    expected = [(1, words["a"]), (2, words["b"]), (2, words["c"]), (3, words["d"]), (4, None), (4, "")]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))

    item = " ".join(words["b"].split()[10:40])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.drop_contaminated(spark, got, str(tmp_path))
    assert sorted(map(repr, map(tuple, left.collect()))) == sorted(map(repr, [r for r in expected if r[1] != words["b"]]))
