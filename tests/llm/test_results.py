"""Results of the operators' queries against SQL, brute force, exact round trips and held-out labels."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, duck_rows, spark_rows
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from martloom.llm import language, near_dedup, packing, pii
from martloom.llm.queries import llm_queries, llm_sql
from martloom.llm.sentencepiece_codec import ChunkTable

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())


def run(spark, name):
    return [r.asDict() for r in llm_queries()[name](spark, FOLDER).collect()]


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in contract.queries()) == 1 for n in names)
    assert "pipeline" in contract.queries() and corpus_pipeline.ORACLE_SQL is None
    assert set(llm_sql()) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_sql(spark, name):
    names, _, found = spark_rows(llm_queries()[name](spark, FOLDER))
    wanted_names, _, wanted = duck_rows(connect(FOLDER), llm_sql()[name])
    assert names == wanted_names and found == wanted and found


def _accuracy(spark, name, column, label):
    truth = dict(duckdb.sql(f"select doc_id, {label}").fetchall())
    held = [r for r in run(spark, name) if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert all(0 <= r["score"] <= 1 for r in held) and len(held) > 50
    return sum(r[column] == truth[r["doc_id"]] for r in held) / len(held)


def test_language_of_held_out_documents(spark):
    assert _accuracy(spark, "op1_language_id", "lang_pred", f"lang from '{FOLDER}/documents.parquet'") > 0.98


def test_toxicity_of_held_out_documents(spark):
    assert _accuracy(spark, "op3_toxicity", "predicted", f"toxic from '{FOLDER}/labels.parquet'") > 0.95


def test_quality_of_held_out_documents(spark):
    assert _accuracy(spark, "op9_quality", "predicted", f"quality from '{FOLDER}/labels.parquet'") > 0.9


def test_folds(spark):
    rows = run(spark, "op9_quality")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_mixtures_are_found(spark):
    rows = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate(
            [("the weather is nice and the water was cold that day", "en"), ("das wetter ist schön und das wasser war kalt", "de")] * 3)],
        "doc_id long, text string, lang string",
    )
    model = language.fit_languages(rows)
    both = "the weather is nice and the water was cold " * 5 + "das wetter ist schön und das wasser war kalt " * 5
    shares = language.mixture(model, both)
    assert set(shares) == {"en", "de"} and abs(shares["en"] - 0.5) < 0.15
    assert set(language.mixture(model, "the water was nice " * 20)) == {"en"}


def test_blocks_of_a_long_text_count_each_letter_once(monkeypatch):
    text = "".join(chr(97 + i * i % 26) + (" " if i % 7 == 0 else "") for i in range(1000))
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "BLOCK", 64)
    parts = language.ngram_counts(text)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def _shingles(text, n):
    words = (text or "").encode().lower().split()
    n = min(n, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def _components(texts, n, percent=80):
    """Component of each document by comparing all pairs of similar size."""
    sets = {i: _shingles(t, n) for i, t in texts.items()}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = Counter()
    for ids in holders.values():
        shared.update((a, b) for k, a in enumerate(ids) for b in ids[k + 1 :])
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return sets, {i: root(i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, docs):
    sets, label = _components(docs, 4)
    found = {r["doc_id"]: r for r in run(spark, "op5_near_dedup")}
    assert len(found) == len(docs)
    for i in docs:
        assert found[i]["n_shingles"] == len(sets[i])
        assert found[i]["component_id"] == label[i] and found[i]["kept"] == (i == label[i])


@pytest.mark.parametrize("short,block,columns", [(8, 2048, 1 << 13), (1, 16, 7), (1000, 2048, 1 << 13)])
def test_large_group_of_different_near_copies(spark, monkeypatch, short, block, columns):
    """By families of one block and of many small ones, and by pairs of lists alone."""
    monkeypatch.setattr(near_dedup, "SHORT", short)
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", block)
    monkeypatch.setattr(near_dedup, "COLUMNS", columns)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        words = list(base)
        for at in rng.choice(150, rng.integers(0, 9), replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        texts[1000 - i] = " ".join(words)
    texts |= {2000 + i: f"common start of all these " + " ".join(f"z{i}_{k}" for k in range(40)) for i in range(60)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, label = _components(texts, 5)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert found == label and len(set(label.values())) > 61


@pytest.mark.parametrize("percent", [40, 60, 100])
def test_other_thresholds(spark, percent):
    rng = np.random.default_rng(percent)
    base = [f"w{i}" for i in range(90)]
    texts = {}
    for i in range(60):
        words = list(base) if i % 2 else [f"{i // 8}v{k}" for k in range(70)]
        for at in rng.choice(70, rng.integers(0, 12), replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        texts[i] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    _, label = _components(texts, 3, percent)
    found = near_dedup.near_duplicates(frame, words=3, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == label
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(frame, percent=0)


def test_packing_is_exact_and_tight(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = run(spark, "op7_best_fit_packing")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in docs.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        wanted = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        found = sorted(pieces[i], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in found] == [(k, 2048 * k, len(w)) for k, w in enumerate(wanted)]
        assert [r["ids_crc32"] for r in found] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in wanted]
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        assert sum(n for _, n in parts) <= 2048
    assert len(sequences) <= 1.01 * -(-sum(r["length"] for r in rows) // 2048) + 1


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "ÀÉ ΣΑΣ İstanbul", "a\x1cb\x85c d", "it's  12\r\n34 é", "\x00 x"])
def test_words_are_encoded_as_the_whole_text(text):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert list(packing.WordTable(path).convert([text])[0]) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_respects_every_capacity(rule):
    rng = np.random.default_rng(5)
    counts = {int(n): int(c) for n, c in zip(rng.choice(100, 30, replace=False) + 1, rng.integers(1, 500, 30))}
    caps = packing.Capacities(tokens=100, documents=7, attention=4000 + 6000, rule=rule)
    bins, seen = defaultdict(list), Counter()
    for length, number, many, first, offset in packing.plan_classes(counts, caps):
        assert number == seen[length]
        seen[length] += many
        for s in range(first, first + many):
            bins[s].append((offset, length))
    assert seen == counts
    for parts in bins.values():
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0, *(n for _, n in parts)])[:-1])
        assert sum(n for _, n in parts) <= 100 and len(parts) <= 7 and sum(n * n for _, n in parts) <= 10_000


def test_a_piece_too_large_is_an_error():
    with pytest.raises(ValueError):
        packing.plan_classes({10: 1}, packing.Capacities(tokens=9))


def test_codec_equals_the_library(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: r for r in run(spark, "op10_sentencepiece")}
    for i, text in docs.items():
        ids = model.encode(text or "")
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("text", [" ", "  ", " a", "a ", "  a  b   c ", "▁", "a▁b", "<s> <0x0A> </s><unk>", "\n\n a\tb", "é😀​ x", "\x00"])
def test_chunks_join_to_the_librarys_ids(monkeypatch, text):
    from martloom.llm import sentencepiece_codec

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for joined in (1 << 20, 4):
        monkeypatch.setattr(sentencepiece_codec, "JOINED_CHARS", joined)
        (ids, decoded), = ChunkTable(path).convert([text * 3])
        assert list(ids) == model.encode(text * 3)
        assert decoded == model.decode(model.encode(text * 3))


def test_spans_on_awkward_texts(spark):
    texts = [
        "a@b.c+d@e.f x@y@z.w",
        "1.2.3.4.5.6.7.8 000001.2.3.4 12.13.14.256",
        "card 4111 1111 1111 1111, 4111111111111112",
        "+1 (499) 555-6503, +123, +1" + "(" * 3000,
        "iban DE89370400440532013000, GB82 WEST 1234 5698 7654 32",
        "a" * 100_000,
        "5" * 20_000 + " a@b" + ".c" * 20_000,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.with_spans(df).orderBy("doc_id").collect()
    found = [[(s["kind"], s["text"]) for s in r["pii_spans"]] for r in rows]
    assert found[:6] == [
        [("email", "a@b.c"), ("email", "+d@e.f"), ("email", "y@z.w")],
        [("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("ip", "000001.2.3.4")],
        [("card", "4111 1111 1111 1111")],
        found[3],
        [("iban", "DE89370400440532013000"), ("iban", "GB82 WEST 1234 5698 7654 32")],
        [],
    ]
    assert [k for k, _ in found[3]] == ["phone"] and found[3][0][1].startswith("+1 (499) 555-6503")
    assert [k for k, _ in found[6]] == ["email"]
    assert rows[4]["pii_spans"][0]["score"] > 0.6


def test_pipeline_equals_brute_force(spark, docs):
    """Each stage on the input it got, and the packed ids of what is left."""
    stages = dict(corpus_pipeline.STAGES)
    left = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = left.columns
    kept = dict(docs)
    kept = {i: t for i, t in kept.items() if any(c.isalpha() for c in t or "")}
    left = stages["language_id"](spark, left, FOLDER)
    assert {r["doc_id"] for r in left.collect()} == set(kept)
    largest = {t: i for i, t in sorted(kept.items())}
    kept = {i: t for i, t in kept.items() if largest[t] == i}
    left = stages["exact_dedup"](spark, left, FOLDER)
    assert {r["doc_id"] for r in left.collect()} == set(kept) and left.columns == columns
    _, label = _components(kept, 5)
    kept = {i: t for i, t in kept.items() if label[i] == i}
    left = stages["near_dedup"](spark, left, FOLDER).cache()
    assert {r["doc_id"] for r in left.collect()} == set(kept) and left.columns == columns
    clean = stages["pii"](spark, left, FOLDER)
    assert clean.columns == columns
    clean = {r["doc_id"]: r for r in clean.collect()}
    assert all(clean[i]["n_chars"] == len(clean[i]["text"]) for i in kept)
    spans = {r["doc_id"]: r["pii_spans"] for r in pii.with_spans(left).collect()}
    assert all((clean[i]["text"] == kept[i]) == (not spans[i]) for i in kept)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(dict)
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        ids[r["doc_id"]][r["piece"]] = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
    assert set(ids) == set(kept)
    for i, parts in ids.items():
        whole = [x for _, part in sorted(parts.items()) for x in part]
        assert whole == tokenizer.encode(clean[i]["text"], add_special_tokens=False).ids + [0]
