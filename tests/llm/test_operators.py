import zlib
from collections import Counter
from pathlib import Path

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from check_oracle import compare, connect
from pyspark.sql import functions as F

from grainframe.llm.components import components
from grainframe.llm.decontaminate import common_subsequence, find_leaks
from grainframe.llm.elias_fano import EliasFano, encode
from grainframe.llm.language_model import score_texts
from grainframe.llm.nbsvm import score_quality
from grainframe.llm.ngram_join import similar_sets
from grainframe.llm.packing import pack_documents, shortest_pack_first
from grainframe.llm.passages import K, _nodes, align, chains, repeated_passages
from grainframe.llm.pii import find_personal_data, mod97, redact
from grainframe.llm.queries import ORACLES, QUERIES, tokenizer_path
from grainframe.llm.repetition import repetition_rules
from grainframe.llm.toxicity import score_toxicity
from grainframe.llm.warc import ARC_BYTES, arc_archive, convert_and_read, read_arc
from grainframe.llm.words import words_of
from grainframe.session import scratch_path


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [tuple(r) for r in documents.select("doc_id", "text").collect()]


def test_packing(documents, texts, odd_docs, no_docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    for docs, rows in ((documents, texts), (odd_docs.where("doc_id <> 3"), None)):
        rows = rows or [tuple(r) for r in docs.select("doc_id", "text").collect()]
        pieces = [r.asDict() for r in pack_documents(docs, tokenizer_path()).collect()]
        brute.check_packing(rows, pieces, model)
    assert pack_documents(odd_docs.where("doc_id = 3"), tokenizer_path()).count() == 2
    assert pack_documents(no_docs, tokenizer_path()).count() == 0
    ids = pack_documents(odd_docs.where("doc_id = 7"), tokenizer_path(), keep_ids=True).first().ids
    assert ids == model.encode("a b", add_special_tokens=False).ids + [2]


def test_shortest_pack_first():
    histogram = {7: 3, 5: 2, 3: 4, 2: 5}
    patterns = shortest_pack_first(histogram, 10)
    used = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 10
        for length in pattern:
            used[length] += count
    assert used == histogram


def test_passages(spark, odd_docs, no_docs):
    words = [f"v{i}" for i in range(60)]
    edited = [*words[:30], "other", *words[31:]]
    rows = [
        (1, " ".join([f"a{i}" for i in range(40)] + words)),
        (2, " ".join([f"b{i}" for i in range(25)] + edited + [f"c{i}" for i in range(25)])),
        (3, " ".join(f"d{i}" for i in range(90))),
    ]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 1
    spans = {found[0].doc_id: (found[0].start, found[0].end),
             found[0].with_doc_id: (found[0].with_start, found[0].with_end)}
    assert spans == {1: (40, 100), 2: (25, 85)} and found[0].identity == round(59 / 60, 6)
    pairs = {(r.doc_id, r.with_doc_id) for r in repeated_passages(odd_docs).collect()}
    assert {(3, 1)} <= pairs and any({1, 2} == set(p) for p in pairs)
    assert repeated_passages(no_docs).count() == 0


def _linked(spark, rows):
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {frozenset((r.doc_id, r.with_doc_id)) for r in found}


def _fresh(tag, n):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_passages_whose_parts_have_other_holders(spark):
    whole = [f"p{i}" for i in range(60)]
    for trial in range(4):
        parts = [" ".join(whole[a : a + 20]) for a in (0, 20, 40)]
        rows = [(10 + k, f"{_fresh(f's{trial}{k}x', 30)} {part} {_fresh(f's{trial}{k}y', 30)}")
                for k, part in enumerate(parts * 4)]
        # several texts a part, so that some node of each is smaller than both
        rows = [(i + 100 * k, f"{text} {k}") for k in range(2) for i, text in rows]
        rows += [(1, f"{_fresh(f'a{trial}', 40)} {' '.join(whole)}"),
                 (2, f"{' '.join(whole)} {_fresh(f'b{trial}', 40)}")]
        assert frozenset((1, 2)) in _linked(spark, rows)


def test_edited_passages_down_to_the_identity(spark):
    rows, pairs = [], 120
    rng = np.random.default_rng(5)
    for k in range(pairs):
        n = 60 if k % 2 else 100
        step = (5, 6, 8, 10)[k % 4] if k % 3 else 7
        a = [f"e{k}w{i}" for i in range(n)]
        b = [f"x{k}w{i}" if (i + 1) % step == 0 and i < n - 1 else w for i, w in enumerate(a)]
        rows.append((2 * k, f"{_fresh(f'l{k}', int(rng.integers(5, 60)))} {' '.join(a)}"))
        rows.append((2 * k + 1, f"{_fresh(f'r{k}', int(rng.integers(5, 60)))} {' '.join(b)}"))
    found = _linked(spark, rows)
    assert all(p in found for p in (frozenset((2 * k, 2 * k + 1)) for k in range(pairs)))


def test_edited_passages_whose_seeds_have_other_holders(spark):
    rows, pairs = [], 6
    for k in range(pairs):
        a = [f"h{k}w{i}" for i in range(70)]
        b = [f"y{k}w{i}" if i % 7 == 6 else w for i, w in enumerate(a)]
        rows += [(2 * k, f"{_fresh(f'l{k}', 40)} {' '.join(a)}"), (2 * k + 1, f"{' '.join(b)} {_fresh(f'r{k}', 40)}")]
        # every unchanged run also stands in texts of its own, one of which is the smallest node with it
        rows += [(1000 + 100 * k + 10 * j + c, f"{_fresh(f'o{k}x{j}x{c}', 30)} {' '.join(a[7 * j : 7 * j + 6])}")
                 for j in range(10) for c in range(8)]
    assert _linked(spark, rows) == {frozenset((2 * k, 2 * k + 1)) for k in range(pairs)}


def test_passages_of_frequent_words_link_all_their_texts(spark):
    whole = [f"f{i}" for i in range(55)]
    rows = [(100 + 20 * j + c, f"{_fresh(f'p{j}x{c}', 30)} {' '.join(whole[11 * j : 11 * j + 14])}")
            for j in range(5) for c in range(20)]
    rows += [(i, f"{_fresh(f'q{i}', 30)} {' '.join(whole)} {_fresh(f't{i}', 30)}") for i in (1, 2, 3)]
    assert _linked(spark, rows) == {frozenset(p) for p in ((1, 2), (1, 3), (2, 3))}


def _among_frequent_seeds(k, kept, edited):
    """Three texts with edits of a passage, and texts that hold each part of it, so that all its seeds are frequent."""
    whole = [f"m{k}w{i}" for i in range(75)]
    texts = [kept(whole), edited(whole, 7, f"x{k}"), edited(whole, 8, f"y{k}")]
    rows = [(1000 * k + i, f"{_fresh(f'u{k}v{i}', 20 + 7 * i)} {' '.join(text)} {_fresh(f'z{k}v{i}', 20)}")
            for i, text in enumerate(texts)]
    parts = [" ".join(text[j : j + 12]) for text in texts for j in range(0, len(text), 8) for _ in range(18)]
    return rows + [(1000 * k + 10 + i, f"{_fresh(f'b{k}c{i}', 12)} {part} {_fresh(f'd{k}c{i}', 12)}")
                   for i, part in enumerate(parts)]


def test_edited_passages_of_frequent_seeds_only(spark):
    def changed(words, step, tag):
        return [f"{tag}s{i}" if i % step == step - 1 else w for i, w in enumerate(words)]

    def dropped(words, step, tag):
        return [w for i, w in enumerate(words) if i % step != step - 1]

    def added(words, step, tag):
        return [v for i, w in enumerate(words) for v in ((w, f"{tag}i{i}") if i % step == step - 1 else (w,))]

    rows = [row for k, edit in enumerate((changed, dropped, added)) for row in _among_frequent_seeds(k, list, edit)]
    assert {frozenset((1000 * k, 1000 * k + i)) for k in range(3) for i in (1, 2)} <= _linked(spark, rows)


def test_near_copies_are_all_linked_with_each_other(spark):
    whole = [f"g{i}" for i in range(120)]
    rng = np.random.default_rng(11)
    rows = []
    for k in range(40):
        text = list(whole)
        for at in range(int(rng.integers(0, 20)), len(text), 24):
            text[at] = f"e{k}x{at}"
        rows.append((k, " ".join(text)))
    assert _linked(spark, rows) == {frozenset((i, j)) for i in range(40) for j in range(i)}


def test_lines_at_many_places_are_passages_wherever_they_stand(spark):
    line = _fresh("o", 9)
    rows = [(i, f"{_fresh(f'h{i}', 30)} {' '.join([line] * n)} {_fresh(f'j{i}', 30)}") for i, n in ((1, 80), (2, 250))]
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    covered = {1: set(), 2: set()}
    for r in found:
        covered[r.doc_id] |= set(range(r.start, r.end))
        covered[r.with_doc_id] |= set(range(r.with_start, r.with_end))
    assert set(range(30, 30 + 9 * 80)) <= covered[1] and set(range(30, 30 + 9 * 250)) <= covered[2]


def test_a_line_in_many_texts_does_not_link_them(spark):
    line = _fresh("q", 14)
    rows = [(i, f"{_fresh(f'k{i}', 40)} {line} {_fresh(f'n{i}', 40)}") for i in range(60)]
    assert not _linked(spark, rows)


def test_passages_of_texts_without_an_id_do_not_hide_others(spark):
    shared = _fresh("n", 70)
    for trial in range(4):
        rows = [(None, f"{shared} {_fresh(f'z{trial}{k}', 20)}") for k in range(12)]
        rows += [(i, f"{_fresh(f'd{trial}{i}', 30)} {shared}") for i in (1, 2)]
        assert _linked(spark, rows) == {frozenset((1, 2))}


def test_texts_come_once_to_all_chains_of_a_pair(spark):
    line = _fresh("k", 12)
    rows = [(i, f"{_fresh(f'd{i}', 20)} {' '.join([line] * (8 + i))}") for i in (1, 2)]
    scratch = Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(scratch.glob("*"))
    assert _linked(spark, rows) == {frozenset((1, 2))}
    left = {p.name.rsplit("-", 1)[0]: p for p in set(scratch.glob("*")) - before}
    pairs = spark.read.parquet(str(left["long-enough"]))
    assert pairs.count() == pairs.select("node", "holder").distinct().count() == 1
    assert not {"nodes", "matches", "longer-matches", "chains"} & set(left)  # read by no later step


def test_waiting_seeds_find_a_holder_that_has_copies(spark):
    shared = _fresh("w", 60)
    texts = [f"{_fresh(f'c{i}x', 30)} {shared} {_fresh(f'c{i}y', 30)}" for i in range(20)]
    nodes = _nodes(words_of(pa.array(texts)))
    rows, least = list(enumerate(texts)), texts[int(nodes.argmin())]
    one = spark.createDataFrame([(100, least)], "doc_id long, text string").coalesce(1)
    docs = one.unionAll(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).unionAll(one)
    found = {frozenset((r.doc_id, r.with_doc_id)) for r in repeated_passages(docs).collect()}
    assert {frozenset((i, int(nodes.argmin()))) for i in range(20) if i != nodes.argmin()} <= found


def test_alignments_of_many_chains_equal_those_of_one():
    rng = np.random.default_rng(3)
    words, bounds, x, y, first = [], [], [], [], [0]
    for _ in range(40):
        a = rng.integers(0, 5, int(rng.integers(40, 90)))
        b = a.copy()
        b[rng.integers(0, len(b), 6)] = 9
        at = np.flatnonzero(np.lib.stride_tricks.sliding_window_view(a == b, K).all(1))[::K]
        for text in (a, b):
            begin = bounds[-1][1] if bounds else 0
            bounds.append((begin, begin + len(text)))
            words.append(text)
        x, y, first = [*x, *at], [*y, *at], [*first, first[-1] + len(at)]
    words, bounds = np.concatenate(words), np.array(bounds)
    many = align(words, bounds[::2], bounds[1::2], np.array(x), np.array(y), np.array(first))
    for k in range(40):
        part = slice(first[k], first[k + 1])
        one = align(words, bounds[2 * k : 2 * k + 1], bounds[2 * k + 1 : 2 * k + 2],
                    np.array(x[part]), np.array(y[part]), np.array([0, first[k + 1] - first[k]]))
        assert [v[0] for v in one] == [v[k] for v in many]
        x0, x1 = int(many[0][k]), int(many[1][k])
        left, right = words[bounds[2 * k][0] :], words[bounds[2 * k + 1][0] :]
        assert many[4][k] * (x1 - x0) >= (left[x0:x1] == right[x0:x1]).sum() - 1e-6


def test_chains_follow_both_orders():
    x, y = np.array([0, 6, 12, 18, 24]), np.array([0, 6, 90, 18, 24])
    assert [c.tolist() for c in chains(x, y, least=6)] == [[0, 1, 3, 4]]


def test_similar_sets(documents, texts, odd_docs, odd_rows, no_docs):
    for docs, rows in ((documents, texts), (odd_docs, odd_rows)):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_sets(docs).collect()}
        assert found == brute.similar(dict(rows).items())
    assert similar_sets(odd_docs).count() == len(odd_rows)
    assert similar_sets(no_docs).count() == 0


def test_sets_without_an_id_link_and_bridge(spark):
    def text(*changed):
        return " ".join(f"c{i}" if i in changed else f"b{i}" for i in range(204))

    one, bridge, two = text(), text(20, 60, 100), text(20, 60, 100, 140, 170, 190)
    rows = [(1, one), (None, bridge), (2, two), (None, bridge), (None, "a b c d e f g")]
    found = similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 1), (0, 1), (1, 1), (2, 1)]


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 101), (7, 3)] + [(200, 200 + i) for i in range(1, 30)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(21)}, 100: 100, 101: 100, **{200 + i: 200 for i in range(30)}}


def test_quality_rules(documents, texts, odd_docs, odd_rows, no_docs):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for docs in (documents, odd_docs):
        for r in repetition_rules(docs).collect():
            assert tuple(r[n] for n in names) == brute.quality(r.text)
            assert not (r.base_failed and r.kept)
    assert repetition_rules(no_docs).count() == 0


def test_archives(spark, folder):
    record = (b"http://a/#record=1", b"HTTP/1.1 200 OK\r\n\r\nbody\nwith lines\n")
    for version in (1, 2):
        got = list(read_arc(arc_archive(version, [record, record])))
        assert [(f["URL"], c) for f, c in got] == [record, record]
    with pytest.raises(ValueError):
        list(read_arc(arc_archive(1, [record])[:-9]))
    big = b"x" * 1200
    rows = [(1, "http://a b", big), (2, None, big), (3, "u", b""), (4, "u", None), (5, "u", b"s"), (6, "u", big)]
    read = {r.key: r for r in convert_and_read(spark.createDataFrame(rows, "key long, url string, payload binary")).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in read.items()} == {
        1: ("revisit", 6, 1200), 2: ("revisit", 6, 1200), 3: ("response", None, 0),
        4: ("response", None, 0), 5: ("response", None, 1), 6: ("response", None, 1200)}
    assert bytes(read[6].payload) == big and ARC_BYTES > 0
    none = spark.createDataFrame([], "key long, url string, payload binary")
    assert convert_and_read(none).count() == 0


def test_classifiers(spark, documents, folder, odd_docs, no_docs):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for score, label, least in ((score_toxicity, "toxic", 0.85), (score_quality, "quality", 0.9)):
        rows = score(documents, labels).join(labels, "doc_id").where("held_out").collect()
        assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)
        odd = score(odd_docs, labels).collect()
        assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
        assert score(no_docs, labels).count() == 0


def test_personal_data(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        for r in find_personal_data(docs).collect():
            spans = brute.personal(r.text)
            assert [r[f"n_{k}"] for k in spans] == [len(v) for v in spans.values()]
            assert r.base_sha256 == brute.base_digest(spans)
    hard = "a@b.c..x@y.z @no.one p@q " + "1.2.3.4.5.6.7.8 " + "9" * 5000 + " x" * 3 + "@d.e"
    from grainframe.llm.pii import find_spans

    found = find_spans(hard)
    assert [s[1:3] for s in found if s[0] == "email"] == brute.personal(hard)["email"]
    assert mod97("DE89370400440532013000") and not mod97("DE89370400440532013001")
    assert redact("ab cd", [("ip", 0, 2, 1.0), ("card", 1, 3, 1.0)]) == "[IP]cd"
    assert find_personal_data(no_docs).count() == 0


def test_leaks(spark, odd_docs, no_docs):
    item = " ".join(f"q{i}" for i in range(40))
    changed = item.replace("q7 ", "z ").replace("q21 ", "")
    filler = " ".join(f"f{i}" for i in range(300))
    docs = spark.createDataFrame(
        [(i, f"{filler} {i} {item if i % 2 else changed} {filler}") for i in range(30)]
        + [(100, filler), (101, None), (102, ""), (103, " ".join(reversed(item.split())))],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in find_leaks(docs, benchmark).collect()}
    assert {i for i, x in found.items() if x == [1]} == set(range(30))
    assert find_leaks(odd_docs, benchmark.where("false")).where("size(leaks) > 0").count() == 0
    assert find_leaks(no_docs, benchmark).count() == 0
    assert common_subsequence(list("abcde"), list("xaybzd")) == 3


def test_elias_fano():
    values = np.unique(np.random.default_rng(1).integers(0, 2**62, 5000))
    sequence = EliasFano(np.frombuffer(encode(values), dtype=np.uint8))
    index = np.arange(len(values))
    assert (sequence[index] == values.astype(np.uint64)).all()
    assert (sequence.find(values) == index).all() and (sequence.find(values + 1) == -1).all()


def test_language_model(spark, documents, texts, odd_docs, no_docs):
    rows = score_texts(documents).collect()
    tokens = {i: [*brute.words(brute.fold(t)), None] for i, t in texts}
    train = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    for r in rows:
        ws = tokens[r.doc_id]
        base = sum(np.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in train for w in ws), n)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
    assert score_texts(odd_docs).count() == odd_docs.count() and score_texts(no_docs).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None


def test_pipeline(spark, folder, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "personal_data", "packing"]
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == documents.columns
        docs = out.cache()
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    pieces = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept
    assert docs.where(F.col("text").rlike("[a-z]@[a-z]+[.][a-z]")).count() == 0
