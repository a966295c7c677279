"""Cases that earlier versions of the operators got wrong."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from martloom.llm import exact_dedup, near_dedup, packing, pii, url_filters
from martloom.llm.queries import llm_queries, llm_sql


def cased_vocabulary(path, lower):
    """A byte-level vocabulary of words, made by hand, that tells capitals from small letters unless told not to."""
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    letters = [chr(c) for c in range(33, 127)]
    merges = [("T", "h"), ("t", "h"), ("Th", "e"), ("th", "e"), ("H", "e"), ("h", "e"), ("o", "r"), ("O", "R")]
    vocabulary = {t: i for i, t in enumerate([*letters, *dict.fromkeys(a + b for a, b in merges)])}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Punctuation("contiguous"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    if lower:
        tokenizer.normalizer = normalizers.Lowercase()
    tokenizer.save(path)
    return tokenizer


@pytest.mark.parametrize("lower", [True, False])
def test_packing_takes_capitals_as_the_vocabulary_does(tmp_path, lower):
    path = str(tmp_path / "words.json")
    tokenizer = cased_vocabulary(path, lower)
    texts = ["Hello World", "hello world", "THE The the OR", "IT'S (The) A1b, heTHE.", ""]
    found = packing.WordTable(path).convert(texts)
    assert [list(ids) for ids in found] == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert lower == (list(found[0]) == list(found[1]))


def test_bracketed_addresses_are_hosts_of_their_own(spark):
    wanted = {
        "http://[2001:DB8::1]/x/y": ("2001:db8::1", ["x", "y"]), "https://u:p@[::1]:80/y?q": ("::1", ["y"]),
        "http://[::ffff:1.2.3.4]": ("::ffff:1.2.3.4", []), "http://[/x": (None, []), "http://[zz]/x": (None, []),
        "http://Host.org:8080/a": ("host.org", ["a"]),
    }
    df = spark.createDataFrame([(u,) for u in wanted], "url string")
    rows = df.select("url", url_filters.host_of(F.col("url")).alias("h"), url_filters.segments_of(F.col("url")).alias("s"))
    assert {r["url"]: (r["h"], r["s"]) for r in rows.collect()} == {
        u: (h, s) for u, (h, s) in wanted.items()
    }


def test_a_text_of_very_many_spans(spark):
    """A log of 20,000 addresses: four times the spans take far less than sixteen times as long."""
    took = []
    for many in (5_000, 20_000, 5_000, 20_000):
        text = " ".join(f"10.{i % 256}.{i // 256 % 256}.7 up" for i in range(many))
        df = spark.createDataFrame([(1, text), (2, "login 1.2.3.4")], "doc_id long, text string")
        began = time.perf_counter()
        rows = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
        took.append(time.perf_counter() - began)
        assert rows == {1: " ".join(["<IP> up"] * many), 2: "login <IP>"}
    assert took[3] < 10 * took[2] + 5
    found = pii.with_spans(df).filter("doc_id = 1").selectExpr("inline(pii_spans)").collect()
    assert len(found) == many and all(text[r["start"] : r["stop"]] == r["text"] for r in found[::97])


def test_words_on_both_sides_raise_the_score(spark):
    texts = {
        "1.2.3.4": 0.5, "server 1.2.3.4": 0.8, "1.2.3.4 is the host": 0.8, "1.2.3.4 " + "x" * 50 + " host": 0.5,
        "host " + "x" * 50 + " 1.2.3.4": 0.5,
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = pii.with_spans(df).selectExpr("text", "pii_spans[0].score as score").collect()
    assert {r["text"]: round(r["score"], 2) for r in found} == texts
    kept = {r["text"] for r in pii.redact(df, least_score=0.7).collect()}
    assert kept == {t.replace("1.2.3.4", "<IP>") if score > 0.7 else t for t, score in texts.items()}


def test_personal_data_query_equals_sql_where_the_tables_hold_no_case(spark, tmp_path):
    """Spaced account numbers before other words, context on both sides, many spans, null texts."""
    texts = [
        "AT61 1904 3002 3457 3201 EUR 500", "my iban DE89 3704 0044 0532 0130 00 A1", "NO93 8601 1117 947 account", None, "",
        "AT61 1904 3002 3457 3201", "card 4111-1111-1111-1111 or +49 (30) 123-456, mail a@b.co!", "x@y.zz wrote to contact",
        " ".join(f"10.0.{i % 300}.1 login" for i in range(700)), "GB82 WEST 1234 5698 7654 32, bank", "GB82WEST12345698765432",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    path = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    cursor = con.execute(llm_sql()["op4_pii"])
    names = [c[0] for c in cursor.description]
    wanted = sorted((tuple(sorted(dict(zip(names, r)).items())) for r in cursor.fetchall()), key=repr)
    found = llm_queries()["op4_pii"](spark, str(tmp_path)).collect()
    assert sorted((tuple(sorted(r.asDict().items())) for r in found), key=repr) == wanted
    spans = {r["doc_id"]: (r["spans"], r["scores"]) for r in found}
    assert spans[0] == ("iban:0:24", "60") and spans[2][1] == "90" and spans[9] == ("iban:0:27", "90")


def near_components(rows, words=5, percent=80):
    """Smallest id reachable from each row (id, text), by comparing all rows with all."""
    cut = [tuple(t.lower().split()) for _, t in rows]
    sets = [{w[k : k + words] for k in range(max(1, len(w) - words + 1))} if w else set() for w in cut]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    places = {}
    masks = [sum(1 << places.setdefault(v, len(places)) for v in s) for s in sets]
    for i, s in enumerate(sets):
        for j in range(i):
            both = (masks[i] & masks[j]).bit_count()
            if both and 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (number, _) in enumerate(rows):
        least[root(i)] = min(number, least.get(root(i), number))
    return sorted((number, len(sets[i]), least[root(i)]) for i, (number, _) in enumerate(rows))


def near_found(frame, **options):
    rows = near_dedup.near_duplicates(frame, **options).collect()
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in rows)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows)


@pytest.mark.parametrize("exact", [False, True])
def test_texts_that_share_an_id_keep_their_links(spark, exact):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (9, "q " + one), (9, "q " + two), (9, "alone")]
    rows += [(7, "x y z"), (7, "x y z"), (8, "X y  z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_found(frame, exact=exact) == near_components(rows)
    kept = near_dedup.drop_near_duplicates(frame, exact=exact).collect()
    assert sorted(map(tuple, kept)) == sorted([(1, one), (1, two), (9, "alone"), (7, "x y z"), (7, "x y z")])


@pytest.mark.parametrize("few", [0, 500_000])
def test_linked_texts_of_one_id_leave_one(spark, monkeypatch, few):
    monkeypatch.setattr(near_dedup, "FEW_IDS", few)
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(4, text), (4, text + " end"), (5, text + " fin"), (6, None), (6, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in near_dedup.drop_near_duplicates(frame).collect()]
    assert sorted(i for i, _ in kept) == [4, 6, 6]


def test_a_family_of_very_many_near_copies(spark, monkeypatch):
    """5,000 near copies in five lengths, cut into blocks that partly cannot meet."""
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 600)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(5_000):
        words = base[: 20 + 10 * (i % 5)]
        for at in rng.sample(range(len(words)), rng.randrange(3)):
            words[at] = f"x{rng.randrange(40)}"
        rows.append((9_000 - i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert near_found(frame) == near_components(rows)


def test_exact_way_finds_pairs_that_sketches_may_miss(spark, monkeypatch):
    """With sketches of four values many links are lost; the exact way loses none."""
    monkeypatch.setattr(near_dedup, "SKETCH", 4)
    rng = random.Random(11)
    rows = []
    for i in range(400):
        words = [f"{i // 2}v{k}" for k in range(100)]
        if i % 2:
            for at in rng.sample(range(100), 3):
                words[at] = "y"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = near_components(rows, percent=70)
    assert near_found(frame, percent=70, exact=True) == wanted
    assert near_found(frame, percent=70) != wanted


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("few", [0, 500_000])
def test_exact_copies_with_ids_that_repeat(spark, monkeypatch, keep, few):
    """Few groups are broadcast, more are joined by digest: the result is the same."""
    monkeypatch.setattr(exact_dedup, "FEW_GROUPS", few)
    rng = random.Random(2)
    texts = ["hot"] * 40 + [f"t{k}" for k in range(60)] + [None, ""]
    rows = [(rng.choice([None, *range(300)]), rng.choice(texts), k) for k in range(900)]
    rows += [(None, "nobody", 1), (None, "nobody", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, keep_id int").repartition(7)
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    best = {}
    for t, ids in groups.items():
        best[t] = (min if keep == "smallest" else max)((i for i in ids if i is not None), default=None)
    found = exact_dedup.exact_duplicates(frame, keep=keep, fan_in=2).collect()
    wanted = [(str(i), str(best[t or ""]), len(groups[t or ""]), i == best[t or ""]) for i, t, _ in rows]
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in found) == sorted(wanted)
    kept = exact_dedup.drop_exact_duplicates(frame, keep=keep, fan_in=2)
    assert kept.columns == frame.columns
    assert sorted((r["text"] or "", str(r["doc_id"])) for r in kept.collect()) == sorted((t, str(i)) for t, i in best.items())
