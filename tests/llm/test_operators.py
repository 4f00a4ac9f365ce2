"""Each operator on awkward rows against a plain version, and on an empty table."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tidemark.llm import (
    context_tree,
    decontamination,
    jaccard_join,
    language_id,
    personal_data,
    quality_rules,
    repeated_spans,
    sentencepiece_bpe,
    token_counts,
)


def same(df, expected):
    """Rows of the frame and of the plain version, without order."""
    assert Counter(map(tuple, df.collect())) == Counter(expected)


def texts_of(rows):
    return [r[1] for r in rows]


class TestQualityRules:
    def test_base_values(self, docs, rows):
        got = quality_rules.judge(docs)
        columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        same(got.select(columns), [(r[0], *plain.quality_base(r[1])) for r in rows])

    def test_distance(self, spark):
        df = spark.createDataFrame([([1, 0], [1, 1]), ([1, 1], [2, 2]), ([0, 0], [1, 1]), ([1, 0], [0, 3])], "a array<bigint>, b array<bigint>")
        got = [r[0] for r in df.select(quality_rules.distance(F.col("a"), F.col("b"))).collect()]
        half = 0.5 * (1 * math.log2(1 / 0.75)) + 0.5 * (0.5 * math.log2(0.5 / 0.75) + 0.5 * math.log2(0.5 / 0.25))
        assert got[0] == pytest.approx(math.sqrt(half))
        assert got[1:] == [0.0, None, 1.0]

    def test_keep_agrees_with_judge(self, docs):
        kept = quality_rules.keep(docs)
        assert kept.columns == docs.columns
        judged = quality_rules.judge(docs).filter("kept").select("doc_id")
        same(kept.select("doc_id"), [tuple(r) for r in judged.collect()])

    def test_empty(self, no_docs):
        assert quality_rules.judge(no_docs).count() == 0
        assert quality_rules.keep(no_docs).count() == 0


class TestDecontamination:
    def items(self, spark, rows):
        words = rows[1][1].split()
        texts = [" ".join(words[5:30]), " ".join(words[5:30]), " ".join(words[40:53]), "one two", "é", "", None, "...", " ".join(words[60:67])]
        return [(k, t) for k, t in enumerate(texts)] + [(None, " ".join(words[70:90])), (3, "a b c")]

    def test_against_plain(self, spark, docs, rows):
        items = self.items(spark, rows)
        got = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
        got = got.select("doc_id", "n_words", "n_hit", F.array_join("items", ","), "contaminated")
        found = plain.contamination(texts_of(rows), items)
        same(got, [(r[0], n, hit, ",".join(ids), bad) for r, (n, hit, ids, bad) in zip(rows, found, strict=True)])

    def test_empty(self, spark, docs, no_docs):
        none = spark.createDataFrame([], "item_id long, text string")
        assert decontamination.contamination(docs, none).filter("n_hit > 0").count() == 0
        assert decontamination.contamination(no_docs, none).count() == 0

    def test_every_shared_window_has_a_fingerprint(self):
        rng = np.random.default_rng(3)
        words = ["".join(chr(97 + c) for c in rng.integers(0, 3, 2)) for _ in range(400)]
        own = " ".join(words).encode()
        made = decontamination.Words(np.frombuffer(own, np.uint8), np.array([0, len(own)]))
        at, _ = made.fingerprints()
        for i in range(len(words) - decontamination.WINDOW + 1):
            assert np.any((at >= i) & (at <= i + decontamination.WINDOW - decontamination.K))


class TestJaccardJoin:
    def test_against_plain(self, docs, rows):
        got = jaccard_join.near_duplicates(docs)
        found = plain.components([(r[0], r[1]) for r in rows])
        same(got.select("doc_id", "n_shingles", "component_id"), [(r[0], *f) for r, f in zip(rows, found, strict=True)])

    def test_empty(self, no_docs):
        assert jaccard_join.near_duplicates(no_docs).count() == 0

    @pytest.mark.parametrize("seed", range(4))
    def test_close_sets_share_an_entry(self, seed):
        rng = np.random.default_rng(seed)
        for _ in range(300):
            size = int(rng.integers(9, 400))
            pool = rng.permutation(np.unique(rng.integers(0, 1 << 62, 2 * size + 40, dtype=np.uint64)))
            often = {int(x): int(rng.integers(0, 3)) for x in pool}
            a = pool[:size]
            common = int(np.ceil(0.9 * size))
            b = np.concatenate([a[:common], pool[size : size + int(rng.integers(0, max(1, size // 20)))]])
            both = len(np.intersect1d(a, b))
            if 100 * both < 90 * (len(a) + len(b) - both):
                continue

            def entries(own):
                own = np.sort(own)
                counts = np.array([often[int(x)] for x in own])
                order = np.argsort(counts, kind="stable")
                return jaccard_join.signatures(own[order], counts[order] == 0, 90)

            assert len(np.intersect1d(entries(a), entries(b)))

    @pytest.mark.parametrize("seed", range(4))
    def test_close_sets_share_an_entry_at_four_fifths(self, seed):
        rng = np.random.default_rng(seed)
        tried = 0
        for _ in range(300):
            size = int(rng.integers(4, 400))
            pool = rng.permutation(np.unique(rng.integers(0, 1 << 62, 2 * size + 40, dtype=np.uint64)))
            often = {int(x): int(rng.integers(0, 3)) for x in pool}
            a = pool[:size]
            gone, more = rng.integers(0, size // 5 + 1), rng.integers(0, size // 4 + 1)
            b = np.concatenate([a[gone:], pool[size : size + more]])
            both = len(np.intersect1d(a, b))
            if 100 * both < 80 * (len(a) + len(b) - both):
                continue
            tried += 1

            def entries(own):
                own = np.sort(own)
                counts = np.array([often[int(x)] for x in own])
                order = np.argsort(counts, kind="stable")
                return jaccard_join.signatures(own[order], counts[order] == 0, 80)

            assert len(np.intersect1d(entries(a), entries(b)))
        assert tried > 50

    @pytest.mark.parametrize("percent", [90, 80])
    def test_parity_bits_keep_close_pairs(self, spark, percent):
        rng = np.random.default_rng(percent)
        vertices, pairs, close, far = [], [], set(), set()
        for border in [1 << k for k in range(7, 15)] * 3:
            size = border - 1 - int(rng.integers(0, 3))
            pool = np.unique(rng.integers(0, 1 << 62, 3 * border, dtype=np.uint64))
            pool = rng.permutation(pool)
            most = int(size / (percent / 100)) - size
            for more in {border - size, max(border - size, most), border}:  # the last is no close pair
                a, b = pool[:size], pool[:size + more]
                (close if 100 * size >= percent * len(b) else far).add((len(vertices), len(vertices) + 1))
                pairs.append((len(vertices), len(vertices) + 1))
                vertices += [(len(vertices) + k, len(x), jaccard_join.parity(x).tolist()) for k, x in enumerate((a, b))]
        got = jaccard_join.may_link(
            spark.createDataFrame(pairs, "a long, b long"),
            spark.createDataFrame(vertices, "vertex long, n long, parity array<bigint>"),
            percent,
        )
        found = {tuple(r) for r in got.collect()}
        assert close <= found
        assert far and not far & found


class TestRepeatedSpans:
    @pytest.mark.parametrize("most", [100_000, 1])
    def test_against_plain(self, docs, rows, most):
        got = repeated_spans.without_repeats(docs, most)
        found = plain.without_repeats(texts_of(rows))
        same(got.drop("kept"), [(r[0], *f) for r, f in zip(rows, found, strict=True)])

    def test_empty(self, no_docs):
        assert repeated_spans.without_repeats(no_docs).count() == 0


def test_segments_by_chunks(monkeypatch):
    """Segments do not depend on how many texts are hashed at a time, and memory follows the chunk, not the piece."""
    import tracemalloc

    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 101, size).astype(np.uint8)) for size in (0, 199, 200, 5_000, 700, 30_000, 1, 2_000)] * 20
    flat, starts = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    tracemalloc.start()
    by_chunk = repeated_spans.Segments(flat, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(flat)
    monkeypatch.setattr(repeated_spans, "CHUNK", 1 << 30)
    at_once = repeated_spans.Segments(flat, starts)
    for name in ("text", "begin", "size", "place", "anchor", "content"):
        assert np.array_equal(getattr(by_chunk, name), getattr(at_once, name))


class TestPersonalData:
    def field(self, docs):
        return personal_data.fit_field(docs)

    def test_base(self, docs, rows):
        got = personal_data.find(docs, self.field(docs))
        expected = []
        for r in rows:
            spans = personal_data.in_order(plain.pattern_spans(r[1]))
            counts = [sum(s[0] == k for s in spans) for k in personal_data.KINDS]
            expected.append((r[0], *counts, plain.sha(personal_data.written(spans).encode())))
        same(got.drop("spans"), expected)
        for row in got.collect():
            text = next(r[1] for r in rows if r[0] == row.doc_id)
            if row.doc_id is not None and text:
                base = personal_data.written(personal_data.in_order(plain.pattern_spans(text)))
                assert set(filter(None, base.split(","))) <= set(row.spans.split(","))

    def test_repetition_carries_a_label(self):
        """A stretch that is in doubt by itself takes the label of the same digits elsewhere."""
        node = np.zeros((personal_data.FEATURES, 5))
        skip = 6 * np.eye(5)
        field = personal_data.Field(node, np.zeros((5, 5)), skip)
        text = "call +49 30 1234567 " + "and so on " * 40 + "or 49 30 1234567 now"
        base = personal_data.base_spans(text)
        assert [s[0] for s in base] == ["phone"]
        added = personal_data.added_spans(field, text, base, 0.9)
        assert [(k, text[a:b]) for k, a, b in added] == [("phone", "49 30 1234567")]
        assert personal_data.added_spans(field, text[20:], [], 0.9) == []

    def test_fitted_field_adds_other_forms(self, spark):
        """Weights and limit as they are learned: an entity that comes again in another form is added, other digits are not."""
        rng = np.random.default_rng(3)

        def entities():
            d = "".join(map(str, rng.integers(0, 10, 10)))
            card = next(c for c in (f"4{d}{k:05d}" for k in range(100)) if personal_data.luhn(c))
            return f"+49 3{d[1]} {d[2:9]}", " ".join(card[k : k + 4] for k in range(0, 16, 4)), f"me{d[:3]}@site{d[3]}.org"

        texts = []
        for k in range(200):
            phone, card, mail = entities()
            texts.append((k, f"Some words. Reach {phone} at noon, or {mail} for more; pay by {card} if need be. Host 10.0.{k}.1 is up."))
        field = personal_data.fit_field(spark.createDataFrame(texts, "doc_id long, text string"))
        hits = wrong = 0
        for _ in range(20):
            phone, card, mail = entities()
            again = [phone[1:], card.replace(" ", "."), mail.replace("@", " [at] ").replace(".", " [dot] ")]
            filler = " and so on" * 30
            text = f"Reach {phone} or {mail}, pay by {card}.{filler} {again[0]} then{filler} {again[1]} then{filler} {again[2]} then"
            digits = entities()
            text += f"{filler} {digits[0][1:]} then {filler} {digits[1].replace(' ', '.')} then on 2024-01-15"
            added = personal_data.added_spans(field, text, personal_data.base_spans(text), field.sure)
            found = [(kind, text[a:b]) for kind, a, b in added]
            hits += sum(x in found for x in zip(("phone", "card", "email"), again, strict=True))
            wrong += sum(x[1] not in again for x in found)
        assert hits >= 54
        assert wrong <= 1

    def test_field_learns_from_every_text(self, spark):
        """All nodes of all texts are counted, and the limit heeds every held-out text."""
        texts = [f"Text {k} has +49 30 {1234567 + k} in it" + f" and me{k}@site.org" * (k % 90) for k in range(2_300)]
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
        *_, counts = personal_data.node_counts(personal_data.telling_texts(docs))
        assert counts.sum() == sum(sum(label >= 0 for label in personal_data.planted_nodes(t)[1]) for t in texts)
        node = np.zeros((personal_data.FEATURES, 5))
        node[0, 3] = 2.0  # takes anything for a phone, at 0.65
        field = personal_data.Field(node, np.zeros((5, 5)), np.zeros((5, 5)))
        shares = [personal_data.sure_of(personal_data.telling_texts(docs), field, wrong) for wrong in (0.0, 1.0)]
        assert shares == [personal_data.SURE, 0.6]

    def test_what_is_planted_stands_apart(self):
        """The spans of a text with planted stretches are its own and theirs, found apart."""
        for text in ("mail a@b.c", "a@b", "+49 30 1234567", "at +4", "1.2.3.4", "4111 1111 1111 1111 ", "x 1.2.3", "me@", "card 4111-1111-"):
            base = personal_data.base_spans(text)
            more, _ = personal_data.planted(text, base)
            moved = [(kind, a + len(text), b + len(text)) for kind, a, b in personal_data.base_spans(more)]
            assert sorted(base + moved) == sorted(personal_data.base_spans(text + more))

    def test_exact_on_a_tree(self):
        """Without circles the messages give the true marginals."""
        rng = np.random.default_rng(1)
        field = personal_data.Field(rng.normal(size=(personal_data.FEATURES, 5)), rng.normal(size=(5, 5)), np.zeros((5, 5)))
        nodes = [personal_data.Node(10 * k, 10 * k + 5, -1, rng.normal(size=personal_data.FEATURES), (str(k),)) for k in range(3)]
        joint = np.zeros((5, 5, 5))
        score = [n.features @ field.node for n in nodes]
        for i in range(5):
            for j in range(5):
                for k in range(5):
                    joint[i, j, k] = score[0][i] + score[1][j] + score[2][k] + field.chain[i, j] + field.chain[j, k]
        joint = np.exp(joint - joint.max())
        joint /= joint.sum()
        expected = [joint.sum((1, 2)), joint.sum((0, 2)), joint.sum((0, 1))]
        assert np.allclose(field.marginals(nodes), expected, atol=2e-3)

    def test_mask(self):
        assert personal_data.mask("a b@c.de 1", [("email", 2, 8), ("ip", 5, 8)]) == "a <email> 1"

    def test_empty(self, no_docs):
        assert personal_data.find(no_docs, personal_data.fit_field(no_docs)).count() == 0


class TestTokenCounts:
    path = public_tokenizers.path("byte_bpe_50k.json")

    @pytest.mark.parametrize("most", [3, 100_000])
    def test_against_library(self, docs, rows, most):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        expected = []
        for r in rows:
            n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
            expected.append((r[0], len((r[1] or "").encode()), n, n > 512))
        same(token_counts.token_counts(docs, self.path, most=most), expected)

    def test_empty(self, no_docs):
        assert token_counts.token_counts(no_docs, self.path).count() == 0


class TestSentencePiece:
    path = public_tokenizers.path("piece_bpe_32k.model")

    def test_against_library(self, docs, rows):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=self.path)
        expected = []
        for r in rows:
            ids = library.encode(r[1] or "", add_eos=True)
            expected.append((r[0], len(ids), plain.sha(" ".join(map(str, ids)).encode()), plain.sha(library.decode(ids).encode())))
        same(sentencepiece_bpe.token_digests(docs, self.path), expected)

    def test_round_trip(self, docs):
        once = sentencepiece_bpe.encode(docs.filter("text is not null and not contains(text, '▁')"), self.path)
        again = sentencepiece_bpe.decode(once, self.path)
        assert again.filter("decoded <> text").count() == 0

    def test_odd_texts(self):
        import random

        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=self.path)
        codec = sentencepiece_bpe.Codec(self.path, most=50)
        rng = random.Random(5)
        pieces = [library.id_to_piece(i) for i in range(259, 32_000)]
        for _ in range(4_000):
            parts = [rng.choice(pieces) if rng.random() < 0.5 else rng.choice("aet \n\t▁.éß中🙂\x00") for _ in range(rng.randint(0, 9))]
            text = "".join(parts)
            ids = library.encode(text)
            assert codec.ids(text).tolist() == ids
            assert codec.pieces.encode(text) == ids
            assert codec.pieces.decode(ids) == library.decode(ids)

    def test_no_new_column_over_an_old_one(self, docs):
        with pytest.raises(ValueError):
            sentencepiece_bpe.encode(docs, self.path, ids="words")

    def test_empty(self, no_docs):
        assert sentencepiece_bpe.token_digests(no_docs, self.path).count() == 0


class TestContextTree:
    def held(self, df):
        return df.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 10 == 0)

    def held_ids(self, rows):
        import zlib

        return [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows]

    @pytest.mark.parametrize("most", [5, 100_000])
    def test_base_score(self, docs, rows, most):
        held = self.held_ids(rows)
        # a row without an id is neither held out nor learned from
        learned = [h or r[0] is None for h, r in zip(held, rows, strict=True)]
        expected = plain.unigram_scores([(x, r[1]) for x, r in zip(learned, rows, strict=True)])
        got = context_tree.score(self.held(docs), most=most)
        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)]
        same(got.select(columns), [(r[0], h, *e[:3], round(e[3], 6)) for r, h, e in zip(rows, held, expected, strict=True)])

    def test_mixture_against_recursion(self):
        train = [b"abracadabra", b"abba baba", "dé".encode()]
        texts = [b"abra", b"zzz", b"", "aé b".encode()]
        flat = np.frombuffer(b"".join(train), np.uint8)
        starts = np.cumsum([0] + [len(t) for t in train])
        found, n = np.unique(context_tree.triples_of(flat, starts), return_counts=True)
        tree = context_tree.fit_tree(found, n)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum([0] + [len(t) for t in texts])
        assert np.allclose(tree.score(flat, starts), plain.context_tree_scores(train, texts), rtol=1e-5)

    def test_sums_to_one(self):
        tree = context_tree.fit_tree(np.array([97 << 16 | 98 << 8 | 99, 98], np.uint32), np.array([5, 2]))
        assert np.allclose((10.0 ** tree.logs.astype(float)).sum(axis=1), 1, atol=1e-4)

    def test_empty(self, no_docs):
        assert context_tree.score(self.held(no_docs)).count() == 0


class TestLanguageId:
    def test_accuracy_and_rules(self, docs, rows):
        samples = language_id.sample_labelled(docs)
        assert samples.languages == ("en", "fr", "ja")
        got = language_id.identify(docs.withColumn("held_out", F.lit(False)), samples).collect()
        assert len(got) == len(rows)
        named = {r.doc_id: r for r in got if r.doc_id is not None}
        for doc_id, text, lang in rows:
            if doc_id is None:
                continue
            found = named[doc_id]
            assert 0 <= found.score <= 1
            if text is None or not any(c.isalpha() for c in text):
                assert (found.lang_pred, found.score) == ("und", 0)
            elif lang and len(text) > 150:
                assert found.lang_pred == lang

    def test_small_samples_do_not_win(self, spark, docs, rows):
        odd = [(900, "", "xa"), (901, "12 ...", "xb"), (902, "a", "xc"), (903, "ok", "xd"), (904, "the", "xe")]
        some = docs.select("doc_id", "text", "lang")
        samples = language_id.sample_labelled(some.union(spark.createDataFrame(odd, some.schema)))
        assert samples.languages == ("en", "fr", "ja", "xc", "xd", "xe")
        got = language_id.identify(docs.withColumn("held_out", F.lit(False)), samples).collect()
        named = {r.doc_id: r.lang_pred for r in got}
        for doc_id, text, lang in rows:
            if doc_id is not None and lang and text and len(text) > 150:
                assert named[doc_id] == lang

    def test_sample_takes_whole_rows(self, spark):
        texts = [(k, f"{'opening ' * 60}{k} rest of the text {k}", "en") for k in range(4)]
        texts += [(10 + k, "é" * 50_000 + "z" * 50_000, "fr") for k in range(3)]
        frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
        samples = language_id.sample_labelled(frame)
        assert sorted(samples.texts[0]) == sorted(t for _, t, lang in texts if lang == "en")
        assert [len(t.encode()) <= 8_192 for t in samples.texts[1]] == [True] * 3
        assert sum(len(t.encode()) for t in language_id.sample_labelled(frame, 800).texts[0]) <= 900

    def test_cost_of_bytes_that_a_sample_lacks(self):
        parser = language_id.Parser(language_id.LanguageSamples(("a", "b"), (("banana band",), ("cocoa",))))
        data = np.frombuffer(b"banzz" + b"" + b"coco", np.uint8)
        got = parser.cost(data, np.array([0, 5, 5, 9]))
        ban, coco = parser.costs
        assert parser.unseen == 8
        # the last phrase of a text counts also where nothing is left for it
        assert np.allclose(got, [[2 * ban + 16, 2 * coco + 32], [0, 0], [ban + 32, coco]])

    def test_phrases_against_plain(self):
        samples = language_id.LanguageSamples(("a", "b"), (("banana band", "nab"), ("cocoa", "tacit xx")))
        parser = language_id.Parser(samples)
        for text in (b"bananab cocoa!", b"", b"zzz", b"TACO banana" * 400):
            folded = bytes(language_id.fold(np.frombuffer(text, np.uint8)))
            own = [[bytes(language_id.fold(np.frombuffer(t.encode(), np.uint8))) for t in x] for x in samples.texts]
            expected = [plain.phrases(folded, x, language_id.BLOCK) for x in own]
            got = parser.phrases(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
            assert np.all(np.abs(got - expected) <= 2 * (1 + len(text) // language_id.BLOCK) + text.count(b"z"))

    def test_nothing_learned(self, docs, no_docs):
        samples = language_id.sample_labelled(no_docs)
        got = language_id.identify(docs.withColumn("held_out", F.lit(False)), samples)
        assert {r.lang_pred for r in got.collect()} == {"und"}
        assert language_id.identify(no_docs.withColumn("held_out", F.lit(False)), samples).count() == 0


def test_numbers_of_any_length_are_no_addresses():
    zeros = "0" * 5_000
    for text in (f"1.2.3.{zeros}1", f"{zeros}.{zeros}1.2.3", f"1.2.3.{zeros}999", "9" * 6_000 + ".1.2.3"):
        assert [s for s in personal_data.base_spans(text) if s[0] == "ip"] == [s for s in plain.pattern_spans(text) if s[0] == "ip"]
    assert personal_data.base_spans(f"1.2.3.{zeros}1") == [("ip", 0, 5_007)]


def test_large_groups_cost_pairs_in_proportion(spark, monkeypatch):
    """Near copies meet one hub a round, and texts that share a passage of frequent n-grams meet none."""
    rng = random.Random(8)
    new = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    base, other, passage = new(200), new(200), new(30)
    rows = []
    for k in range(400):
        near = base.copy()
        near[rng.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(near)))
    for k in range(400, 800):
        rows.append((k, " ".join([*new(60), *passage, *new(60)])))
    for k in range(800, 1_000):  # too far from each other by their own words, which no other text has
        far = other.copy()
        for at in (20, 60, 100, 140, 180):
            far[at] = f"y{k}x{at}"
        rows.append((k, " ".join(far)))
    made = []
    whole = jaccard_join.may_link

    def counted(pairs, vertices, percent):
        made.append(pairs.count())
        return whole(pairs, vertices, percent)

    monkeypatch.setattr(jaccard_join, "may_link", counted)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r.component_id for r in got.collect()}
    assert found == {k: 0 if k < 400 else k for k in range(1_000)}
    assert len(made) == jaccard_join.HUB_ROUNDS + 1 and sum(made) < 2 * len(rows)


def test_decode_odd_ids_as_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(6)
    byte = [library.piece_to_id(f"<0x{b:02X}>") for b in (0x20, 0x41, 0x80, 0xA0, 0xB8, 0xC0, 0xE4, 0xED, 0xF0, 0x9F, 0x99, 0x82)]
    some = [0, 1, 2, *byte, *[library.piece_to_id(p) for p in ("▁the", "▁", "a", "é", "s")]]
    rows = [([rng.choice(some) for _ in range(rng.randint(0, 9))],) for _ in range(2_000)]
    got = sentencepiece_bpe.decode(spark.createDataFrame(rows, "ids array<int>"), path).collect()
    for ids, text in got:
        assert text == library.decode(ids), ids
