import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom.llm import brown, chat, decontaminate, extract, language, mixing, quality, search, simhash
from barloom.llm.components import connected_components
from barloom.scratch import BATCH, settle, settle_at

ODD = [(1, None), (2, ""), (2, ""), (3, "one two three"), (None, "one two three"), (4, "x" * 50_000), (5, " \t\n "), (6, "w " * 20_000)]


def good(n, seed=0):
    rng = random.Random(seed)
    return " ".join(rng.choice(["river", "mountain", "walks", "quiet", "under", "the", "old", "bridge"]) for _ in range(n))


def bad(n, seed=0):
    return " ".join(w.upper() + "!!" for w in good(n, seed).split())


# Quality


def labelled(spark, documents, n=60):
    rows = [(k, good(30, k) if k % 2 else bad(30, k)) for k in range(n)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(n)], "doc_id long, quality int")
    return documents(*rows), labels


def test_quality_tells_classes_apart_and_scores_odd_texts(spark, documents):
    docs, labels = labelled(spark, documents)
    model = quality.train_quality(docs, labels)
    assert model.score(good(40, 999)) > 0.7 > 0.3 > model.score(bad(40, 998))
    scored = documents(*ODD).select("doc_id", quality.quality_score(model, F.col("text")).alias("s")).collect()
    assert len(scored) == len(ODD) and all(0 <= r["s"] <= 1 for r in scored)
    assert model.score(None) == model.score("")


def test_quality_without_labels_or_with_one_class_or_conflicts(spark, documents):
    docs, labels = labelled(spark, documents, 12)
    none = quality.train_quality(docs, labels.where("false"))
    assert none.score("a b") == pytest.approx(0.5)
    ones = quality.train_quality(docs, labels.where("quality = 1"))
    assert ones.score("a b") == pytest.approx(7 / 8)
    both = labels.unionByName(labels.withColumn("quality", F.lit(None).cast("int"))).unionByName(labels.where("doc_id = 1").withColumn("quality", F.lit(0)))
    assert quality.train_quality(docs, both).score(good(30)) > 0.5
    assert quality.train_quality(docs.where("false"), labels).score("x") > 0


def test_dual_coordinate_descent_meets_the_optimum():
    sets = [np.array(x) for x in ([0, 1], [0, 2], [3, 4], [3, 5], [1, 4])]
    labels, scale = np.array([1, 1, 0, 0, 1]), np.ones(6)
    w, b = quality.dual_coordinate_descent(sets, labels, scale, epochs=2000, tolerance=1e-10)

    def loss(w, b):
        return (w @ w + b * b) / 2 + sum(max(0, 1 - (1 if y else -1) * (w[s].sum() / math.sqrt(2) + b)) for s, y in zip(sets, labels, strict=True))

    rng = np.random.default_rng(1)
    assert all(loss(w, b) <= loss(w + d[:6], b + d[6]) + 1e-9 for d in rng.normal(0, 0.05, (300, 7)))


# Language


def test_language_nearest_centroid(spark, documents):
    words = {"aa": ["banana", "papaya", "mango"], "bb": ["strudel", "schnitzel", "brezel"]}
    rows = [(k, " ".join(random.Random(k).choices(words[x], k=12)), x) for k, x in enumerate(["aa", "bb"] * 30)]
    model = language.train_languages(documents(*rows, (900, "nothing", None), (None, "banana", "aa")))
    assert model.languages == ["aa", "bb"]
    assert model.predict("mango papaya")[0] == "aa" and model.predict("BREZEL schnitzel!!")[0] == "bb"
    assert model.predict("12 !! 34") == (None, 0.0, True) and model.predict(None)[0] is None
    assert model.predict("zzq xxk zzq")[2]
    found = documents(*ODD).select(language.language_of(model, F.col("text")).alias("x")).collect()
    assert len(found) == len(ODD) and all(0 <= r["x"]["score"] <= 1 for r in found)
    empty = language.train_languages(documents(*rows).where("false"))
    assert empty.predict("banana")[0] is None


# SimHash


def brute_components(rows, radius):
    prints = [simhash.fingerprint(t) for _, t in rows]
    owner = list(range(len(rows)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                owner[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[root(i)] for i in range(len(rows))]


def test_simhash_against_brute_force(documents):
    rng = random.Random(3)
    rows = list(ODD)
    for k in range(40):
        text = good(60, k // 4).split()
        text[rng.randrange(60)] = "changed"
        rows.append((100 + k, " ".join(text)))
    found = simhash.simhash_components(documents(*rows), keep=["lang"], radius=9, tile=7).collect()
    want = Counter((i, c) for (i, _), c in zip(rows, brute_components(rows, 9), strict=True))
    assert Counter((r["doc_id"], r["component_id"]) for r in found) == want


@pytest.mark.parametrize("strip", [1, 3, 100])
def test_links_of_strips_connect_what_is_near(spark, strip):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 30, dtype=np.int64)
    flips = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 7), replace=False)) for b in base for _ in range(8)]
    prints = sorted({*map(int, base), *flips, 0, -1, 1})
    distinct = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(3)
    got = dict(map(tuple, connected_components(simhash.fingerprint_links(distinct, 3, tile=5, strip=strip)).collect()))
    want = brute_groups(prints, 3)
    assert {frozenset(p for p in prints if got.get(p, p) == r) for r in {got.get(p, p) for p in prints}} == want


def brute_groups(prints, radius):
    groups = [{p} for p in prints]
    for i, p in enumerate(prints):
        for q in prints[:i]:
            if ((p ^ q) & (1 << 64) - 1).bit_count() <= radius:
                a, b = (next(g for g in groups if x in g) for x in (p, q))
                if a is not b:
                    a |= b
                    groups.remove(b)
    return set(map(frozenset, groups))


def test_fingerprint_uses_the_engines_hash(spark):
    text = "A b\tc  d e"
    hashes = [r[0] & (1 << 64) - 1 for r in spark.createDataFrame([("a b c d",), ("b c d e",)], "s string").select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if all(h >> b & 1 for h in hashes))
    assert simhash.fingerprint(text) == want and simhash.fingerprint(" ") == 0


def test_simhash_of_an_empty_table(documents):
    assert simhash.simhash_components(documents((1, "a")).where("false")).count() == 0


def test_links_of_a_dense_group_are_a_forest():
    a = np.array([1 << k for k in range(60)] + [0], np.uint64)
    x, y = simhash.links_between(a, a, 2)
    assert len(x) == 60


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{k: 0 for k in range(51)}, 100: 0, 200: 200, 201: 200}


# Decontamination


def brute_near(text, items, window, slop):
    """Places inside windows whose words each stand within ``slop`` of theirs, over all alignments, and the items that have one."""
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    near, found = set(), set()
    for item_id, item in items:
        own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (item or "").lower())
        n = min(window, len(own))
        for delta in range(-len(own) - slop, len(words) + slop + 1) if own else ():
            met = [any(0 <= delta + p + k < len(words) and words[delta + p + k] == w for k in range(-slop, slop + 1)) for p, w in enumerate(own)]
            for start in range(len(own) - n + 1):
                if all(met[start : start + n]):
                    near |= {delta + p for p in range(start, start + n)}
                    found |= {str(item_id)} if item_id is not None else set()
    return len(near), sorted(found)


def brute_hits(text, items, window):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item_id, item in items:
        own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (item or "").lower())
        n = min(window, len(own))
        for s in range(len(own) - n + 1) if own else ():
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[s : s + n]:
                    hit |= set(range(p, p + n))
                    found.add(str(item_id)) if item_id is not None else None
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, documents):
    rng = random.Random(5)
    vocabulary = "a b c d é f".split()
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, make(5)), (2, make(2)), (3, make(9)), (4, ""), (5, None), (6, "the"), (None, make(4)), (1, make(3)), (10, "b B.b-b")]
    rows = [(k, make(60)) for k in range(25)] + [(25, "The, THE! the"), (25, "The, THE! the"), *ODD]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(documents(*rows), table, window=4, slop=1).collect()
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found)
    want = Counter()
    for i, t in rows:
        n, hits, ids = brute_hits(t, items, 4)
        want[(i, n, hits, tuple(ids))] += 1
    assert got == want
    near = Counter((r["doc_id"], r["n_near"], tuple(r["near_items"])) for r in found)
    assert near == Counter((i, n, tuple(ids)) for (i, t) in rows for n, ids in [brute_near(t, items, 4, 1)])


def test_proximity_matches_allow_small_shifts(spark, documents):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = documents((1, "alpha beta gamma delta"), (2, "alpha gamma beta delta"), (3, "alpha x y z beta gamma delta"), (4, "alpha beta"), (5, "gamma delta alpha beta"))
    found = {r["doc_id"]: (r["n_hit"], r["near_items"]) for r in decontaminate.contamination(docs, items, window=4, slop=1).collect()}
    assert found == {1: (4, ["1"]), 2: (0, ["1"]), 3: (0, []), 4: (0, []), 5: (0, [])}


def test_decontamination_of_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(*ODD), items).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(documents((1, "a")).where("false"), items).count() == 0


# Mixing


def test_mix_meets_targets_and_reruns_agree(documents):
    rows = [(k, "w " * (1 + k * 7 % 40), "en", None if k % 3 == 2 else f"s{k % 3}") for k in range(300)] + [(None, None), (7, ""), (7, "")]
    docs = documents(*rows)
    found = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in found) == Counter((r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(7)).collect())
    total = sum(r["size"] for r in found)
    targets, taken = {}, Counter()
    by_id = dict(enumerate(r[3] if len(r) > 3 else "s" for r in rows[:300]))
    for r in found:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
        if r["doc_id"] is not None and r["size"]:
            taken[by_id[r["doc_id"]]] += r["taken"]
            targets[by_id[r["doc_id"]]] = r["target"]
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(taken[s] == pytest.approx(t, rel=0.02) for s, t in targets.items())


def test_targets_fill_up_by_weight(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 100), ("c", 40), (None, 50), ("d", 0)], "source string, source_size long")
    got = {r["source"]: (r["weight"], r["target"]) for r in mixing.source_targets(sources).collect()}
    # 300 to share; a stops at 20, d (weight 5) at 0, c (weight 1) and b and null (2 each) share the rest.
    assert got["a"] == (5, 20) and got["d"] == (5, 0) and got["b"][0] == 2 and got["c"][0] == 1 and got[None][0] == 2
    assert got["c"][1] == pytest.approx(60) and got[None][1] == pytest.approx(100) and got["b"][1] == pytest.approx(120)


def test_mix_of_an_empty_table(documents):
    assert mixing.mix(documents((1, "a")).where("false")).count() == 0


# Chat


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "### user: hi </turn>\n### x", "\\", "a\\", "####", "</</turn>", "", None, " ", "\n", "%23", "é日", "x" * 30_000]
    rows = [(k, t, ["user", "assistant", "a: b%\n", None][(k + t) % 4], nasty[(k * 5 + t) % len(nasty)]) for k in range(6) for t in range(9)]
    rows += [(None, None, "assistant", "n"), (0, 0, "user", "tie"), (0, 0, "user", "tie")]
    found = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    out = found.select("*", chat.parse(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), chat.loss_spans(F.col("formatted"))).alias("masked")).collect()
    assert all(r["identical"] for r in out) and {r["level"] for r in out} >= {0, 1}
    for r in out:
        own = sorted((x for x in rows if x[0] == r["conv_id"]), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        assert r["masked"] == "".join(x[3] or "" for x in own if x[2] == "assistant")


def test_chat_of_an_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# Language model


def test_brown_base_counts_and_probabilities(documents):
    rows = [(k, good(40, k) + (" rare%d" % k)) for k in range(40)] + [(i and 1000 + i, t) for i, t in ODD if i != 2] + [(1002, "")] * 2
    found = brown.brown_scores(documents(*rows), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)), classes=6).collect()
    counts = Counter(w for i, t in rows if i is not None and i % 3 for w in brown.tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    assert len(found) == len(rows)
    for r in found:
        own = brown.tokens(texts[r["doc_id"]])
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        assert r["train_tokens"] == total and r["n_tokens"] == len(own) and r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    new = [r for r in found if r["doc_id"] is not None and not r["trained"] and r["doc_id"] < 40]
    assert sum(r["score"] for r in new) > sum(r["base_score"] for r in new)


@pytest.mark.parametrize("seed", [2, 3])
def test_brown_probabilities_sum_to_one(seed):
    """Over all words and the unknown words of all spellings, after any class."""
    rng = np.random.default_rng(seed)
    classes, words = 6, 300
    own, counts = rng.integers(0, classes - 1, words), rng.geometric(0.4, words).astype(float)
    spelled = rng.integers(0, brown.SHAPES, words)
    tokens_of, words_of = np.bincount(own, counts, classes), np.bincount(own, minlength=classes).astype(float)
    single = np.zeros((brown.SHAPES, classes))
    np.add.at(single, (spelled[counts == 1], own[counts == 1]), 1)
    taken, unknown, left = brown.word_shares(tokens_of, words_of, single, float((counts == 2).sum()))
    chance = 10 ** brown.transitions(rng.poisson(2, (classes, classes)).astype(float), np.ones(classes))
    assert np.allclose(chance.sum(1), 1)
    known = (counts - taken[own]) / tokens_of[own]
    of_class = np.bincount(own, known, classes) + np.bincount(unknown, 10 ** left[unknown], classes)
    assert np.allclose(of_class[tokens_of > 0], 1) and (known > 0).all()
    nothing = brown.word_shares(np.zeros(3), np.zeros(3), np.zeros((brown.SHAPES, 3)), 0)
    assert np.allclose(np.bincount(nothing[1], 10 ** nothing[2][nothing[1]], 3)[nothing[1][0]], 1)


def class_information(bigrams, owner, classes):
    table = np.zeros((classes, classes))
    np.add.at(table, (owner[:, None], owner[None, :]), bigrams)
    g = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return g(table) - g(table.sum(0)) - g(table.sum(1))


def test_exchange_ends_where_no_move_gains():
    rng = np.random.default_rng(4)
    bigrams = rng.poisson(3, (20, 20)) + 20 * (np.arange(20)[:, None] % 4 == (np.arange(20)[None, :] + 1) % 4)
    owner = brown.exchange_classes(bigrams, 4, sweeps=50)
    best = class_information(bigrams, owner, 4)
    for w in range(20):
        for c in range(4):
            moved = owner.copy()
            moved[w] = c
            assert class_information(bigrams, moved, 4) <= best + 1e-6
    start = np.empty(20, int)
    start[np.argsort(-(bigrams.sum(0) + bigrams.sum(1)), kind="stable")] = np.arange(20) % 4
    assert best > class_information(bigrams, start, 4)


def test_brown_without_training_rows(documents):
    found = brown.brown_scores(documents((1, "a b")), F.lit(False)).collect()
    assert found[0]["base_score"] == 0 and found[0]["n_known"] == 0 and math.isfinite(found[0]["score"])
    assert brown.brown_scores(documents((1, "a")).where("false"), F.lit(True)).count() == 0


# Search


def brute_top(rows, query, k):
    tf = [Counter(search.WORD.findall((t or "").encode().lower())) for _, t in rows]
    lengths = [sum(c.values()) for c in tf]
    mean, df = sum(lengths) / len(rows), Counter(w for c in tf for w in c)
    scores = []
    for (i, _), c, n in zip(rows, tf, lengths, strict=True):
        s = sum(math.log1p((len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * n / mean)) for w in tf[query] if c[w])
        if s > 0:
            scores.append((-round(s, 6), i is None, i))
    return sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]


def test_search_against_brute_force(documents):
    rows = [(k, good(20 + k % 30, k) + f" t{k % 9}") for k in range(120)] + [(200, good(25, 3) + " t3"), (220, None), (None, "bridge t3"), (240, "x" * 9_000)]
    found = search.top_k(documents(*rows), F.col("doc_id") % 20 == 0, k=5, shard_words=900)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-round(r["score"], 6), r["doc_id"] is None, r["doc_id"]))
    want = {i: brute_top(rows, n, 5) for n, (i, t) in enumerate(rows) if i is not None and i % 20 == 0 and t}
    assert got == want


def test_search_gives_workers_few_rows_at_once(spark, documents, monkeypatch):
    within = []

    def watched(df):
        within.append(spark.conf.get(BATCH))
        return settle(df)

    monkeypatch.setattr(search, "settle", watched)
    before = spark.conf.get(BATCH)
    assert search.top_k(documents((20, "a b"), (21, "a")), F.col("doc_id") == 20).count() == 2
    assert within == [str(search.ROWS)] * 3
    assert spark.conf.get(BATCH) == before


def test_search_gives_back_only_the_best_of_all_shards(documents, monkeypatch):
    """Rows that leave the search grow with the queries, not with queries times shards, and nothing is shuffled to bring them together."""
    made = []

    def watched(df):
        found = settle_at(df)
        made.append((df, found[0].count()))
        return found

    monkeypatch.setattr(search, "settle_at", watched)
    rows = [(k, good(20, k)) for k in range(200)]
    assert search.top_k(documents(*rows), F.col("doc_id") % 20 == 0, k=5, shard_words=100).count() == 50
    (_, shards), (_, batches), (found, n) = made
    assert shards > 20 and batches == 1 and n == 50
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan


def test_search_of_an_empty_table(documents):
    assert search.top_k(documents((1, "a")).where("false"), F.lit(True)).count() == 0


# Extraction

FRAME = "<html><head><title>T</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav><div class='box7'>Join our <b>club</b></div>%s<footer>&copy; x</footer></body></html>"


def test_extraction_removes_templates_and_furniture(spark):
    def article(k):
        return f"<article><h1>Title {k}</h1><p>First &amp;\n <i>second</i><br>line {k}<p>All rights reserved.</p><div class='box9'>Rate this page</div><div class='comments'><p>Nice</p></div><script>x<y</script></article>"

    rows = [(k, "https://Site.org/p", FRAME % article(k)) for k in range(20)] + [(50, "https://site.org/q", FRAME % article(50))] * 3
    rows += [(60, None, None), (61, "x", ""), (62, "http://other.net", "<p>a &lt; b<p>c</article>")]
    found = extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows)
    assert texts[3] == "Title 3\n\nFirst & second line 3\n\nAll rights reserved."
    assert texts[50] == "Title 50\n\nFirst & second line 50\n\nAll rights reserved."
    assert texts[60] == "" and texts[61] == "" and texts[62] == "a < b\n\nc"


def test_extraction_keeps_the_article_of_copied_pages(spark):
    page = FRAME % "<article><h1>Same</h1><p>Text</p></article>"
    rows = [(k, "https://copy.org/a", page + f"<!-- {k} --><div class='ad'>{k}</div>") for k in range(30)]
    found = extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert [r["text"] for r in found.select("text").distinct().collect()] == ["Same\n\nText"]


def test_reader_survives_broken_markup():
    for page in ("<", "<a", "<!--", "</p></b>", "<script>", "<p title='", "<ul><li>a<li>b</ul>", "&#x110000; &bogus; &amp", "<b>" * 3000 + "x"):
        assert isinstance(extract.main_text(extract.read_page(page)), str)
    assert extract.main_text(extract.read_page("<ul><li>a<li>b</ul>")) == "a\n\nb"


def test_template_needs_different_parents(spark):
    rows = [("h", FRAME % f"<article><p>{k % 3}</p></article>") for k in range(30)]
    codes = extract.site_templates(spark.createDataFrame(rows, "host string, html string"), min_parents=4, min_share=0.1)
    assert codes.count() == 0


def test_folds_match_crc32(spark):
    from barloom.llm.common import in_fold

    got = {r["i"]: r["f"] for r in spark.range(50).select(F.col("id").alias("i"), in_fold(F.col("id"), 5, 0).alias("f")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_every_word_has_a_class_by_exchange(spark, documents, monkeypatch):
    monkeypatch.setattr(brown, "TYPES", 3)
    monkeypatch.setattr(brown, "FREQUENT", 8)
    # Words of two kinds in turn, all with one spelling of their last two bytes and each rare: only their neighbours tell them apart.
    rng = random.Random(11)
    text = lambda: " ".join(f"{'mn'[j % 2]}{rng.randrange(40)}xx" for j in range(30))
    found = {}

    def noted(*a, f=brown.exchange_words, **b):
        found["out"] = f(*a, **b)
        return found["out"]

    monkeypatch.setattr(brown, "exchange_words", noted)
    rows = [(k, text()) for k in range(90)]
    scored = brown.brown_scores(documents(*rows), F.col("doc_id") < 60, classes=4).collect()
    owners, table, told = found["out"]
    words = {w for k, t in rows if k < 60 for w in brown.tokens(t)}
    own = {r["key"]: r["class"] for r in owners.collect()}
    assert len(own) >= len(words) - 4 and set(own) <= {brown.word_key(w) for w in words}
    kinds = {c: Counter(w[:1] for w in words if own.get(brown.word_key(w)) == c) for c in set(own.values())}
    assert len(own) - sum(max(x.values()) for x in kinds.values()) <= 4
    assert told == sorted(told) and told[-1] > told[0] and table.sum() == sum(len(brown.tokens(t)) for k, t in rows if k < 60)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in scored)


def test_word_keys_are_the_engines_hash(spark):
    words = [b"", b"a", "é日".encode(), b"x" * 100]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w binary").select(F.xxhash64("w")).collect()]
    assert got == [brown.word_key(w) for w in words]


def test_extraction_keeps_every_article_and_other_text_of_the_body(spark):
    body = "<body class='has-sidebar'><nav>Home</nav><div class='box7'>Join our club</div><h1>Day %d</h1><article><p>One %d</p></article><div><article><p>Two %d</p></article></div><footer>x</footer></body>"
    rows = [(k, "https://two.org/p", f"<html>{body % (k, k, k)}</html>") for k in range(20)]
    found = extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["page_id"]: r["text"] for r in found.collect()} == {k: f"Day {k}\n\nOne {k}\n\nTwo {k}" for k in range(20)}


def test_template_share_is_of_different_pages_and_no_more_than_enough(spark):
    copied = [("c", FRAME % f"<article><p>{k % 100}</p></article>") for k in range(1000)]
    large = [("l", f"<div class='box7'>{'Offers' if k < 50 else k}</div><article><p>{k}</p></article>") for k in range(400)]
    few = [("f", f"{'<div class=box7>Offers</div>' if k < 10 else ''}<article><p>{k}</p></article>") for k in range(100)]
    found = extract.site_templates(spark.createDataFrame(copied + large + few, "host string, html string"))
    codes = {r["host"]: set(r["codes"]) for r in found.collect()}

    def texts(rows):
        out = set()
        for host, page in rows:
            root = extract.read_page(page)
            extract.code_subtrees(root)
            out.add(extract.main_text(root, codes.get(host, set())))
        return out

    assert texts(copied) == {str(k) for k in range(100)}
    assert texts(large[:50]) == {str(k) for k in range(50)}
    assert texts(few[:10]) == {f"Offers\n\n{k}" for k in range(10)}


def test_every_language_is_learned(documents):
    # Each language has letters of its own; the last ones are the rarest.
    word = lambda n: chr(0x4E00 + 3 * n) + chr(0x4E01 + 3 * n)
    names = [f"l{n:03d}" for n in range(230)]
    rows = [(1000 * k + n, word(n), names[n]) for n in range(230) for k in range(2 if n < 200 else 1)]
    model = language.train_languages(documents(*rows))
    assert model.languages == names
    assert [model.predict(word(n))[0] for n in range(230)] == names


def test_a_language_whose_rows_share_an_id_is_learned(documents):
    english = [(k, f"the house of the river {k}", "en") for k in range(50)]
    for shared in (7, 1234567, 99999989):
        german = [(shared, f"das haus an der strasse {k}", "de") for k in range(2500)]
        model = language.train_languages(documents(*english, *german))
        assert model.languages == ["de", "en"] and model.predict("der strasse das haus")[0] == "de"


def test_languages_of_an_empty_table_and_too_many_of_them(spark, documents):
    none = language.train_languages(documents((1, "a")).where("false"))
    found = documents(*ODD).select(language.language_of(none, F.col("text")).alias("f")).collect()
    assert len(found) == len(ODD) and all(r["f"]["lang"] is None and r["f"]["rejected"] for r in found)
    many = documents(*[(k, f"text of language {k}", f"l{k}") for k in range(20)])
    with pytest.raises(ValueError, match="centroids of all languages take"):
        language.train_languages(many, model_bytes=1000)
    assert len(language.train_languages(many).languages) == 20


def test_row_hash_sees_maps_and_variants(spark):
    df = spark.sql("SELECT 1 AS a, map('x', k) AS m, parse_json(concat('{\"y\": ', k, '}')) AS v, array(named_struct('z', map(1, k))) AS s FROM VALUES (1), (2), (2) AS t(k)")
    from barloom.llm.common import row_hash

    for columns in (["a", "m"], ["v"], ["s"], ["a", "m", "v", "s"]):
        part = df.select(*columns)
        assert part.select(row_hash(part).alias("h")).distinct().count() == 2
    part = df.select("a")
    assert part.select(row_hash(part).alias("h")).distinct().count() == 1


def test_wand_equals_scoring_every_document_and_skips_blocks(monkeypatch):
    """The best of a shard for many queries, against scores of all its documents; of one topic's queries most blocks are skipped."""
    rng = np.random.default_rng(5)
    topics = [rng.choice(10_000, 60, replace=False) + 1 for _ in range(20)]
    docs = []
    for n in range(1500):
        words = np.concatenate((rng.choice(topics[n % 20], rng.integers(0, 40)), rng.integers(0, 30, rng.integers(0, 10))))
        docs.append(np.unique(words, return_counts=True))
    docs[7] = docs[8] = docs[9]
    lengths = [int(c.sum()) for _, c in docs]
    mean = float(np.mean(lengths))
    index = search.ShardIndex([t.astype(np.int64) for t, _ in docs], [c.astype(np.int32) for _, c in docs], lengths, mean)
    scored = []
    plain = index._scores
    monkeypatch.setattr(index, "_scores", lambda blocks, query: scored.append(len(blocks)) or plain(blocks, query))
    for n in [*range(0, 1500, 60), 7]:
        terms = docs[n][0].astype(np.int64)
        idf = 1 + (terms % 7) / 3
        got = dict(zip(*[x.tolist() for x in index.top(terms, idf, 10)], strict=True))
        want = {}
        for d, (t, c) in enumerate(docs):
            norm = search.K1 * (1 - search.B + search.B * lengths[d] / mean)
            hit = np.isin(t, terms)
            w = c[hit] * (search.K1 + 1) / (c[hit] + norm)
            if hit.any():
                want[d] = float((w * idf[np.searchsorted(terms, t[hit])]).sum())
        last = sorted(want.values())[-10:][0] if want else 0
        best = {d for d, x in want.items() if x > last + 1e-9}
        assert best <= set(got) and len(got) >= min(10, len(want)) and all(abs(got[d] - want[d]) < 1e-8 for d in got)
        assert not got or min(got.values()) >= last - 1e-8
    assert sum(scored) < 0.6 * 26 * index.blocks
    assert index.top(np.array([99_999]), np.array([1.0]), 3)[0].tolist() == []
    none = search.ShardIndex([], [], [], 1.0)
    assert none.top(np.array([1]), np.array([1.0]), 3)[0].tolist() == []
    empty = search.ShardIndex([np.empty(0, np.int64)] * 3, [np.empty(0, np.int32)] * 3, [0, 0, 0], 0.0)
    assert empty.top(np.array([1]), np.array([1.0]), 3)[0].tolist() == []


def test_groups_of_queries_over_several_shards_equal_scoring_every_document(monkeypatch):
    """Queries in groups of at most three, thresholds carried from shard to shard, blocks skipped by them; ties go by id, null last."""
    monkeypatch.setattr(search, "GROUP", 3)
    monkeypatch.setattr(search, "GROUP_TERMS", 120)
    rng = np.random.default_rng(11)
    topics = [rng.choice(3_000, 60, replace=False) + 100 for _ in range(6)]
    docs = [np.unique(np.concatenate((rng.choice(topics[n % 6], rng.integers(0, 50)), rng.integers(0, 40, 12))), return_counts=True) for n in range(900)]
    docs[10] = docs[400] = docs[401] = docs[899]
    ids = [None if n == 400 else 900 - n for n in range(900)]
    lengths = [int(c.sum()) for _, c in docs]
    mean, asks = float(np.mean(lengths)), [10, *range(0, 900, 60)]
    every = [docs[n][0].astype(np.int64) for n in asks]
    names, number = np.unique(np.concatenate(every), return_inverse=True)
    idf = 1 + (names % 7) / 3
    batch = search.QueryBatch(asks, asks, names, idf, np.r_[0, np.cumsum([len(x) for x in every])], number, 10)
    scored = []
    plain = search.ShardIndex._scores
    monkeypatch.setattr(search.ShardIndex, "_scores", lambda self, blocks, query: scored.append(len(blocks) * len(query[3])) or plain(self, blocks, query))
    for low in range(0, 900, 300):
        some = range(low, low + 300)
        order, *postings = search.shard_postings([docs[n][0].astype(np.int64) for n in some], [docs[n][1].astype(np.int32) for n in some], [lengths[n] for n in some])
        batch.search(search.ShardIndex.of(*postings, mean), [ids[some[d]] for d in order])
    for terms, found in zip(every, batch.found, strict=True):
        want = []
        for d, (t, c) in enumerate(docs):
            hit = np.isin(t, terms)
            w = c[hit] * (search.K1 + 1) / (c[hit] + search.K1 * (1 - search.B + search.B * lengths[d] / mean))
            want.append((-round(float((w * (1 + (t[hit] % 7) / 3)).sum()), 7), ids[d] is None, ids[d]))
        want.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        assert [(round(s, 7), none, i) for s, none, i in found] == want[:10]
    assert sum(scored) < 0.8 * len(asks) * 900 / search.BLOCK


def test_postings_take_few_bytes_and_come_back():
    for most, size in ((0, 1), (255, 1), (256, 2), (65_535, 2), (65_536, 4), (2**31 - 1, 4)):
        raw = search._narrow(np.array([1, most, 0]))
        assert len(raw) == 4 + 3 * size and search._wide(pa.py_buffer(raw)).tolist() == [1, most, 0]
    assert search._wide(pa.py_buffer(search._narrow(np.empty(0, np.int32)))).tolist() == []


def test_chat_with_clashing_columns(spark):
    rows = [(1, 0, "user", "hi", "f", ["t"], 1), (1, 1, "assistant", None, None, None, None), (1, 1, "assistant", None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, turns array<string>, spans int")
    made = chat.format_conversations(turns)
    plain = chat.format_conversations(turns.select("conv_id", "turn", "role", "text"))
    assert [r["formatted"] for r in made.collect()] == [r["formatted"] for r in plain.collect()]


def test_scores_of_an_empty_table(spark, documents):
    docs, labels = labelled(spark, documents, 12)
    for model in (quality.train_quality(docs, labels), quality.train_quality(docs.where("false"), labels.where("false"))):
        assert docs.where("false").select(quality.quality_score(model, F.col("text")).alias("s")).collect() == []
    model = language.train_languages(docs)
    assert docs.where("false").select(language.language_of(model, F.col("text")).alias("f")).collect() == []


def test_exact_scores_beside_small_weights():
    """Weights of the blocks take four bytes; what comes out has the scores, and the ties, of double precision."""
    rng = np.random.default_rng(8)
    docs = [np.unique(rng.integers(0, 400, 150), return_counts=True) for _ in range(300)]
    docs[40] = docs[41] = docs[42]
    lengths = [int(c.sum()) for _, c in docs]
    index = search.ShardIndex([t.astype(np.int64) for t, _ in docs], [c.astype(np.int32) for _, c in docs], lengths, 150.0)
    assert index.dense.itemsize == index.block_most.itemsize == index.weight.itemsize == 4 and len(index.dense) > 100
    idf = np.log1p(rng.random(400) * 50)
    for q in (40, 41, 7, 0):
        terms = docs[q][0].astype(np.int64)
        want = []
        for (t, c), n in zip(docs, lengths, strict=True):
            w = c * (search.K1 + 1) / (c + search.K1 * (1 - search.B + search.B * n / 150.0))
            want.append(float((w * idf[t] * np.isin(t, terms)).sum()))
        got = dict(zip(*[x.tolist() for x in index.top(terms, idf[terms], 12)], strict=True))
        last = sorted(want)[-12]
        assert set(got) == {d for d, x in enumerate(want) if x >= last - 1e-8} and all(abs(got[d] - want[d]) < 1e-8 for d in got)
        assert q not in (40, 41) or len({got[d] for d in (40, 41, 42)}) == 1


def test_many_queries_over_parts_equal_brute_force(documents):
    """From some number of queries on shards are looked through together, in parts of like documents; equal texts, empty texts and a null id among them."""
    rows = [(k, good(20 + k % 30, k % 90) + f" t{k % 9}") for k in range(search.MANY + 30)] + [(900, None), (None, "bridge t3"), (920, "x" * 9_000 + " t3")]
    found = search.top_k(documents(*rows), F.lit(True), k=5, shard_words=900)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-round(r["score"], 6), r["doc_id"] is None, r["doc_id"]))
    want = {i: brute_top(rows, n, 5) for n, (i, t) in enumerate(rows) if t}
    assert got == want


def test_parts_equal_scoring_every_document_and_are_skipped(monkeypatch):
    """Parts and groups of a few, several shards at once; those that a query's threshold is above are skipped, and an index is built for all queries at once."""
    for name, value in (("MANY", 1), ("TOGETHER", 7), ("PART", 64), ("HELD", 5_000)):
        monkeypatch.setattr(search, name, value)
    rng = np.random.default_rng(12)
    topics = [rng.choice(3_000, 60, replace=False) + 100 for _ in range(6)]
    docs = [np.unique(np.concatenate((rng.choice(topics[n % 6], 30), rng.integers(0, 40, 12))), return_counts=True) for n in range(900)]
    for n in range(0, 900, 20):
        docs[n] = docs[n % 60]
    docs[5] = (np.empty(0, np.int64), np.empty(0, np.int64))
    docs[6] = np.arange(50, 2_000), np.full(1_950, 300)
    ids = [None if n == 400 else 900 - n for n in range(900)]
    lengths = [int(c.sum()) for _, c in docs]
    mean, asks = float(np.mean(lengths)), [6, 10, *range(0, 900, 25)]
    every = [docs[n][0].astype(np.int64) for n in asks]
    names, number = np.unique(np.concatenate(every), return_inverse=True)
    batch = search.QueryBatch(asks, asks, names, 1 + (names % 7) / 3, np.r_[0, np.cumsum([len(x) for x in every])], number.astype(np.int32), 10)
    built, scored = [], []
    part, add = search.Part.__init__, search.Part.add
    monkeypatch.setattr(search.Part, "__init__", lambda self, *a: built.append(len(a[0])) or part(self, *a))
    monkeypatch.setattr(search.Part, "add", lambda self, scores, *a: scored.append(scores.size) or add(self, scores, *a))
    for low in range(0, 900, 100):
        some = range(low, low + 100)
        order, *postings = search.shard_postings([docs[n][0].astype(np.int64) for n in some], [docs[n][1].astype(np.int32) for n in some], [lengths[n] for n in some])
        batch.look_through(*postings, mean, [ids[some[d]] for d in order])
    batch.look()
    assert 0 < sum(built) <= 899 and max(built) <= 64 and sum(scored) < 0.9 * 899 * len(asks)
    for terms, found in zip(every, batch.found, strict=True):
        want = []
        for d, (t, c) in enumerate(docs):
            hit = np.isin(t, terms)
            w = c[hit] * (search.K1 + 1) / (c[hit] + search.K1 * (1 - search.B + search.B * lengths[d] / mean))
            if hit.any():
                want.append((-round(float((w * (1 + (t[hit] % 7) / 3)).sum()), 9), ids[d] is None, ids[d]))
        want.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        assert [x[1:] for x in found] == [x[1:] for x in want[:10]] and all(abs(x[0] - y[0]) < 1e-7 for x, y in zip(found, want, strict=False))


def test_terms_of_several_texts_at_once():
    texts = ["", "a", "A a,É é", None, "  ", "x\n", " 12ab-C", "ab", "ab", "ß" * 3, "y" * 70 + " " + "Y" * 70 + " " + "y" * 71, "abcdefgh abcdefghi abcdefgh", "end"]
    for kind in (pa.string(), pa.large_string()):
        whole = pa.array(texts, kind)
        known = {}
        for low in range(len(texts) + 1):
            terms, counts, sizes, words = search.term_counts(whole.slice(low))
            ends = np.cumsum(sizes)
            for n, text in enumerate(texts[low:]):
                want = Counter(search.WORD.findall((text or "").encode().lower()))
                mine = slice(ends[n] - sizes[n], ends[n])
                assert words[n] == sum(want.values()) and sizes[n] == len(want) and sorted(counts[mine]) == sorted(want.values())
                assert terms[mine].tolist() == sorted(terms[mine].tolist())
                for w in want:
                    one = pa.array([w.decode()], kind)
                    h = known.setdefault(w, search.term_counts(one)[0][0])
                    assert dict(zip(terms[mine].tolist(), counts[mine].tolist(), strict=True))[h] == want[w]
        assert len(set(known.values())) == len(known)
