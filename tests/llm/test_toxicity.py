"""The random field against enumeration, and held-out accuracy of the scores."""

import itertools
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

from wordbond.llm import queries, toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, _id string, _toxic string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, toxic int")


def corpus():
    """A made-up corpus: documents with a stem of the bad kind are toxic."""
    rows, marks = [], []
    for i in range(400):
        words = [f"w{chr(97 + i * j % 26)}{chr(97 + j % 26)}er" for j in range(20)]
        if i % 4 == 0:
            words[i % 20] = "Grumph" + "abcdefgh"[i // 4 % 8] + "xyz"[i % 3] + "."
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 4 == 0)))
    return rows, marks


def brute_marginals(emission, moves):
    totals = np.zeros(len(emission))
    whole = 0.0
    for tags in itertools.product((0, 1), repeat=len(emission)):
        score = sum(e for e, tag in zip(emission, tags) if tag)
        score += sum(moves[a, b] for a, b in zip(tags, tags[1:]))
        whole += np.exp(score)
        totals += np.exp(score) * np.array(tags)
    return totals / whole


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(0)
    lengths = np.array([3, 1, 7, 5, 7])
    emission, moves = draw.normal(size=lengths.sum()) * 2, draw.normal(size=(2, 2))
    forward, backward = toxicity.log_odds(emission, lengths, moves)
    found, at = toxicity._sigmoid(forward + backward), 0
    for n in lengths:
        assert np.allclose(found[at:at + n], brute_marginals(emission[at:at + n], moves))
        at += n


def test_sentences_and_long_chains(monkeypatch):
    monkeypatch.setattr(toxicity, "CHAIN", 3)
    text = "Ab c, d e f! É1x\n\n.g".encode()
    assert list(toxicity.sentences(text)) == [[b"ab", b"c", b"d"], [b"e", b"f"], ["É".encode(), b"x"], [b"g"]]
    assert list(toxicity.sentences(b" 12 .. ")) == []


def test_unseen_forms_are_found_with_their_offsets(spark, workspace):
    rows, marks = corpus()
    model = toxicity.fit_toxicity(table(spark, rows), labels(spark, marks), workspace)
    odd = [(1000, None), (1001, ""), (1002, "é GRUMPHqq wz, ok"), (1003, "calm werer words"), (None, "grumphnew"),
           (1002, "é GRUMPHqq wz, ok"), (1004, "calm werer. " * 100_000), (1005, "calm werer " * 100_000 + "grumpha")]
    found = toxicity.score_toxicity(table(spark, odd), model, with_spans=True).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)
    assert {i for i, r in by_id.items() if r.predicted} == {1002, None, 1005}
    (span,) = by_id[1002].spans
    assert (span.start, span.end) == (2, 10) and span.probability > 0.5
    assert by_id[1000].score == by_id[1001].score < 0.5
    clean = toxicity.keep_clean(table(spark, odd), model).collect()
    assert sorted(r.doc_id for r in clean) == [1000, 1001, 1003, 1004]
    assert clean[0]._id == "a"


def test_nothing_is_learnt_from_held_out_documents(spark, workspace):
    rows, marks = corpus()
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in marks]
    scores = []
    for mark in (marks, flipped):
        model = toxicity.fit_toxicity(table(spark, rows), labels(spark, mark), workspace)
        found = toxicity.score_toxicity(table(spark, rows), model).collect()
        scores.append(sorted((r.doc_id, r.score) for r in found))
    assert scores[0] == scores[1]


@pytest.mark.parametrize("marks, predicted", [([], 0), ([(1, 0), (2, 0), (3, None)], 0), ([(1, 1), (2, 1), (2, 0)], 1)])
def test_labels_of_one_kind(spark, workspace, marks, predicted):
    rows = [(i, f"text {i}") for i in range(10)]
    model = toxicity.fit_toxicity(table(spark, rows), labels(spark, marks), workspace)
    found = toxicity.score_toxicity(table(spark, rows), model).collect()
    assert {r.predicted for r in found} == {predicted}
    assert toxicity.score_toxicity(table(spark, []), model).collect() == []


def test_query_on_held_out_documents(spark):
    found = {r.doc_id: r for r in queries.op8_crf_toxicity(spark, SF).collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(truth[i], r.predicted) for i, r in found.items() if r.held_out and i in truth]
    assert sum(t == p for t, p in judged) / len(judged) > 0.95
    assert sum(t and p for t, p in judged) / max(1, sum(t for t, _ in judged)) > 0.6


def rare_corpus():
    """As above, with one toxic document in twenty."""
    rows, marks = corpus()
    calm = {i: rows[i + 1][1] for i in range(0, 400, 4) if i % 20}
    return [(i, calm.get(i, text)) for i, text in rows], [(i, int(t and i not in calm)) for i, t in marks]


def test_copies_of_a_toxic_text_leave_the_marked_beginnings(spark, workspace, monkeypatch):
    rows, marks = rare_corpus()
    copies = range(1000, 1200)  # a third of all rows; an id that stands twice with one text is a copy too
    more, more_marks = rows + [(i, rows[20][1]) for i in copies] + [rows[20]], marks + [(i, 1) for i in copies]
    learnt, seen = toxicity._training_sentences, []
    monkeypatch.setattr(toxicity, "_training_sentences", lambda sample, lexicon, *more: (
        seen.append(lexicon), learnt(sample, lexicon, *more))[1])
    for docs, known in ((rows, marks), (more, more_marks)):
        toxicity.fit_toxicity(table(spark, docs), labels(spark, known), workspace)
    assert "grump" in seen[0] and seen[0] == seen[1]


def test_an_id_with_several_texts_counts_each_text_once(spark, workspace):
    rows = [(1, "same"), (1, "other"), (1, "other"), (2, "same"), (2, None), (3, ""), (3, "same")]
    known = labels(spark, [(1, 1), (2, 0), (3, 0)])
    labelled = toxicity._labelled(table(spark, rows), known, "doc_id", "text")
    texts, once = toxicity._distinct(labelled, workspace)
    found = sorted((r._id, bytes(r._text), r._toxic) for r in once.collect())
    assert found == [(1, b"other", True), (1, b"same", True), (2, b"", False)]
    assert toxicity._count_labels(texts) == (2, 1)


def test_the_sample_holds_distinct_texts(spark, workspace, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCUMENTS", 20)
    rows, marks = corpus()
    hot = [(4, f"{rows[4][1]} {i}") for i in range(300)]  # one toxic id with many texts
    docs, known = rows + [(i, rows[8][1]) for i in range(1000, 1500)] + hot, marks + [(i, 1) for i in range(1000, 1500)]
    labelled = toxicity._labelled(table(spark, docs), labels(spark, known), "doc_id", "text")
    texts, once = toxicity._distinct(labelled, workspace)
    found = toxicity._sample(once, texts).collect()
    assert sum(r._toxic for r in found) == 10 and len({bytes(r._text) for r in found}) == len(found) == 20


def test_copies_leave_the_fit(spark, workspace, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_DOCUMENTS", 120)
    rows, marks = corpus()
    copies = range(1000, 1200)
    odd = table(spark, [(2000, "a grumphew here"), (2001, "calm werer words")])
    scores = []
    for docs, known in ((rows, marks), (rows + [(i, rows[20][1]) for i in copies], marks + [(i, 1) for i in copies])):
        model = toxicity.fit_toxicity(table(spark, docs), labels(spark, known), workspace)
        scores.append({r.doc_id: r.score for r in toxicity.score_toxicity(odd, model).collect()})
    assert scores[0] == pytest.approx(scores[1]) and scores[0][2000] > 0.5 > scores[0][2001]


def test_pieces_hold_every_word_once_and_hits_in_the_middle():
    draw = np.random.default_rng(1)
    for size, window in itertools.product((1, 4, 5, 23, 200), (4, 5)):
        for share in (0, 0.02, 0.3, 1):
            hit = (draw.random(size) < share).astype(int).tolist()
            pieces = [list(range(size))[piece] for piece in toxicity._pieces(hit, window)]
            assert sum(pieces, []) == list(range(size)) and all(0 < len(piece) <= window for piece in pieces)
    assert list(toxicity._pieces([0] * 20 + [1] + [0] * 9, 8)) == [
        slice(0, 8), slice(8, 16), slice(16, 24), slice(24, 30)]


def test_marked_words_deep_in_long_sentences_are_learnt_from(spark):
    words = [b"calm"] * 900
    for place in range(100, 900, 100):
        words[place] = b"grumph%c" % (97 + place // 100)
    rows = [(b" ".join(words), True), (b" ".join([b"calm"] * 200), False)]
    sample = spark.createDataFrame(rows, "_text binary, _toxic boolean")
    chains = toxicity._training_sentences(sample, {"grump"})
    marked = [sentence for sentence, tags in chains if any(tags)]
    assert all(len(sentence) <= toxicity.WINDOW for sentence, _ in chains) and len(marked) == 6
    assert sorted({w for sentence in marked for w in sentence} - {b"calm"}) == [b"grumph%c" % c for c in b"bcdfgh"]
    assert all(bool(tag) == word.startswith(b"grump") for s, t in chains for word, tag in zip(s, t))


def test_no_beginning_that_passes_is_dropped(spark, workspace):
    # 6,000 toxic words of their own kind: each has five beginnings, and all of them pass.
    words = [f"z{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}qqqqq" for i in range(6000)]
    rows = [(" ".join(words).encode(), True)] * 30 + [(b"calm", False)] * 570
    once = spark.createDataFrame(rows, "_text binary, _toxic boolean")
    lexicon = toxicity._lexicon(once, 30, 570, workspace)
    expected = {mark for word in words for mark in toxicity._beginnings(word.encode())}
    assert len(expected) > 20_000 and {row.beginning for row in lexicon.collect()} == expected
    sample = spark.createDataFrame([(f"calm {words[0]}".encode(), True)], "_text binary, _toxic boolean")
    assert toxicity._marks(sample, lexicon) == set(toxicity._beginnings(words[0].encode()))


def plain_score(text, model):
    """The score of a text from a given model, by trying all tags of every sentence."""
    text = (text or "").encode()
    marginals = []
    for sentence in re.split(rb"[.!?\n]+", text.lower()):
        words = [word.decode().lower() for word in re.findall(rb"[a-z\x80-\xff]+", sentence)]
        if not words:
            continue
        assert len(words) <= 12
        own = []
        for place, word in enumerate(words):
            names = ["", word + "$", "-" + word[-3:], *[word[:n] for n in toxicity.BEGINNINGS if n < len(word)]]
            if place:
                names.append("<" + words[place - 1][:4])
            if place + 1 < len(words):
                names.append(">" + words[place + 1][:4])
            own.append(sum(model.weights.get(name, 0.0) for name in names))
        total, toxic = 0.0, [0.0] * len(words)
        for tags in itertools.product((0, 1), repeat=len(words)):
            score = sum(o for o, tag in zip(own, tags) if tag)
            score += sum(model.moves[a][b] for a, b in zip(tags, tags[1:]))
            weight = math.exp(score)
            total += weight
            for place, tag in enumerate(tags):
                toxic[place] += weight * tag
        marginals += [t / total for t in toxic]
    odds = [max(-30.0, min(30.0, math.log(p) - math.log1p(-p))) for p in marginals]
    one, largest, expected, length = model.curve
    line = one + largest * max(odds, default=-30.0)
    line += expected * math.log1p(sum(1 / (1 + math.exp(-o)) for o in odds)) + length * math.log1p(len(odds))
    return 1 / (1 + math.exp(-line))


def test_scores_equal_trying_all_tags(spark, workspace):
    rows, marks = corpus()
    model = toxicity.fit_toxicity(table(spark, rows), labels(spark, marks), workspace)
    draw = random.Random(9)
    vocabulary = sorted({word for _, text in rows for word in text.replace(".", " ").split()})
    texts = [
        ". ".join(" ".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 9))) for _ in range(draw.randrange(1, 4)))
        for _ in range(60)
    ] + [None, "", " . ! ", "unseen", "Unseen WORDS\nand other ones?"]
    found = toxicity.score_toxicity(table(spark, list(enumerate(texts))), model).collect()
    scores = {r.doc_id: r for r in found}
    for i, text in enumerate(texts):
        assert scores[i].score == pytest.approx(plain_score(text, model), abs=1e-9)
        assert scores[i].predicted == (scores[i].score >= 0.5)
    assert {r.predicted for r in found} == {0, 1}


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables")
def test_held_out_accuracy_on_more_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in queries.op8_crf_toxicity(spark, sf_dir).collect() if r.held_out}
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(truth[i], r.predicted) for i, r in found.items() if i in truth]
    toxic = sum(t for t, _ in judged)
    assert sum(t and p for t, p in judged) >= 0.92 * toxic
    assert sum(p and not t for t, p in judged) <= 0.015 * (len(judged) - toxic)
