"""Operators on small tables with nulls, blanks, repeats, ties, long texts and clashing columns."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from altimart.llm import (
    bpe,
    components,
    decontaminate,
    exact_dedup,
    fitting,
    langid,
    lm,
    ngram_join,
    quality,
    sharding,
    substring,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, n long, sig string, grp int, key long, bucket int, hash long"


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]

    def some(n):
        return [rng.choice(words) for _ in range(n)]

    common, base = some(45), some(60)
    texts = [None, "", " \n\t", "one", "One  two\nthree", "one two three", "a b c d e", "A B\tC d e"]
    texts += [" ".join(base)] * 40 + [" ".join(base[:k] + ["x"] + base[k + 1 :]) for k in range(0, 60, 1)]
    texts += [" ".join(some(rng.randrange(5, 80)) + common + some(rng.randrange(0, 30))) for _ in range(30)]
    texts += [" ".join(common + some(3)) for _ in range(30)]
    texts += ["  ".join(some(rng.randrange(1, 50))) for _ in range(20)]
    long = some(30_000)
    texts += [" ".join(long), " ".join(long[:20_000] + some(400) + long[20_000:])]
    rows = list(enumerate(texts))
    rows += [rows[9], rows[100], (5, "another text under a known id, long enough to matter here")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "s", 2, 3, 4, 5) for i, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [(1, "x")]).where("doc_id > 1")


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if not sets[i] or not sets[j] or min(len(sets[i]), len(sets[j])) * 100 < percent * max(len(sets[i]), len(sets[j])):
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted((doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("frequent", [24, 3])
@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_ngram_join(docs, rows, width, percent, frequent, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    got = sorted(tuple(r) for r in ngram_join.alike(docs, width=width, percent=percent).collect())
    assert got == brute_components(rows, width, percent)


@pytest.mark.parametrize("block", [1024, 7])
def test_one_signature_of_many_different_texts(spark, monkeypatch, block):
    """A passage that many texts share, which are alike only in a few pairs far apart in the order."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FREQUENT", 5)
    rng = random.Random(12)
    shared = [f"s{i}" for i in range(70)]
    own = [[f"o{i}x{k}" for k in range(25)] for i in range(120)]
    texts = [shared + o for o in own] + [shared + o[:-1] + ["z"] for o in own[:30]] + [shared] * 3
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = sorted(tuple(r) for r in ngram_join.alike(frame(spark, rows)).collect())
    assert got == brute_components(rows, 4, 85)


def test_signatures_are_shared_by_all_alike():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 300)
        universe = np.array(sorted(rng.sample(range(1 << 40), n + n // 4 + 2)), np.uint64)
        kind = {int(u): rng.choice([1, 1, 2, 2, 2]) for u in universe}
        x = set(rng.sample([int(u) for u in universe], n))
        y, drop = set(x), rng.randrange(0, ngram_join.allowance(n, 85) + 1)
        y -= set(rng.sample(sorted(x), min(drop, n - 1)))
        if 100 * len(x & y) < 85 * len(x | y):
            continue
        found = []
        for s in (x, y):
            names = np.array(sorted(s), np.uint64)
            found.append(ngram_join.signatures(names, np.array([kind[int(v)] for v in names]), len(s), 85))
        assert len(np.intersect1d(*found))


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(4)
    for n in (1, 30, 3000):
        x = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        y = np.unique(np.append(x[n // 5 :], rng.integers(0, 1 << 60, n // 7 + 1, dtype=np.uint64)))
        bits = np.unpackbits((ngram_join.parity(x) ^ ngram_join.parity(y)).view(np.uint8)).sum()
        assert bits <= len(np.setxor1d(x, y))


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 200)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {got[i] for i in [*range(41), 200]} == {0} and {got[i] for i in range(100, 140)} == {100}


def test_containment(spark, docs, rows):
    rng = random.Random(5)
    long = rows[188][1].split()
    items = [(1, " ".join(long[500:520])), (2, " ".join(long[900:940]).upper().replace(" ", ", ")), (3, "too short"), (4, None), (None, rows[8][1])]
    items += [(5, " ".join(long[50:70] + ["q"] + long[71:90])), (6, " ".join(rng.sample(long, 30)))]
    items += [(7, long[3]), (8, " ".join(long[10:12])), (9, " ".join(long[20:24])), (10, long[20] + " nowhere"), (11, "?!")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.contained_items(docs, tests).select("doc_id", "item_id", "n_item_shingles", "n_shared").collect()}

    def split(text):
        return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()

    def runs(text, k):
        w = split(text)
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    want = {}
    for i, text in rows:
        for item, wanted in items:
            k = min(5, len(split(wanted)))
            q = runs(wanted, k) if k else set()
            both = len(q & runs(text, k))
            if item is not None and q and 100 * both >= 80 * len(q):
                want[i, item] = max(want.get((i, item), (0, 0)), (len(q), both))
    assert got == {(*k, *v) for k, v in want.items()} and {k[1] for k in want} >= {1, 2, 5, 7, 8, 9}


def test_substring(docs, rows):
    def brute():
        w = [(t or "").encode().split() for _, t in rows]
        first = {}
        for (i, _), ws in zip(rows, w):
            for k in range(len(ws) - 12):
                run = tuple(ws[k : k + 13])
                first[run] = min(i, first.get(run, i))
        for (i, _), ws in zip(rows, w):
            gone = set()
            for k in range(len(ws) - 12):
                if first[tuple(ws[k : k + 13])] < i:
                    gone |= set(range(k, k + 13))
            yield i, len(ws), len(gone), b" ".join(x for k, x in enumerate(ws) if k not in gone).decode()

    got = [(r.doc_id, r.n_words, sum(s.length for s in r.spans), r.kept) for r in substring.repeated_passages(docs).collect()]
    assert sorted(got) == sorted(brute())


def test_exact_duplicates(docs, rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join((t or "").split()), []).append((-len(t or ""), i))
    got = exact_dedup.exact_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.kept for r in got) == len(groups)
    want = sorted((i, min(g)[1], len(g)) for g in groups.values() for _, i in g)
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == want


def test_results_come_through_the_directory(spark, docs, rows, monkeypatch):
    """Without the directory's slots nothing is found; with half of them only what their buckets hold."""
    want = {(r.doc_id, r.text_sha256, r.keep_id) for r in exact_dedup.exact_duplicates(docs, capacity=4).collect()}
    whole = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda *a, **k: whole(*a, **k).where("false"))
    assert exact_dedup.exact_duplicates(docs, capacity=4).isEmpty()
    monkeypatch.setattr(exact_dedup, "directory", lambda *a, **k: whole(*a, **k).where("slot % 2 = 0"))
    half = exact_dedup.exact_duplicates(docs, capacity=4).collect()
    assert 0 < len(half) < len(rows) and {(r.doc_id, r.text_sha256, r.keep_id) for r in half} < want


def test_texts_with_one_key_are_told_apart_by_their_bytes(spark):
    texts = ["b", "a", "b", "a", "a", "c", "b"]
    keyed = spark.createDataFrame([(7, t, k) for k, t in enumerate(texts)], "key long, bare string, n int")
    keyed = keyed.select("key", "bare", F.col("n").cast("decimal(38,0)").alias("choice"))
    index, slots = exact_dedup.build_index(keyed)
    got = [(r.chain, r.group_size, int(r.choice)) for r in index.orderBy("chain").collect()]
    assert got == [(1, 3, 4), (2, 3, 6), (3, 1, 5)]


def test_exact_duplicates_of_a_repeated_row(spark):
    rows = [(5, "x y")] * 400 + [(4, "xy")] * 3 + [(6, None)] * 2 + [(None, "zz"), (None, "z z")]
    got = exact_dedup.exact_duplicates(frame(spark, rows), carried=["text"]).collect()
    assert sorted((r.doc_id or 0, r.text, r.keep_id) for r in got if r.kept) == [(0, "z z", None), (5, "x y", 5), (6, None, 6)]
    assert {(r.doc_id, r.group_size) for r in got} == {(5, 403), (4, 403), (6, 2), (None, 2)}


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("key"))
    slots = exact_dedup.directory(keys, capacity=20)
    bits = exact_dedup.BITS
    held = keys.withColumn("slot", F.expr(f"shiftrightunsigned(key, {64 - bits})")).join(slots, "slot")
    sizes = held.groupBy("depth", F.expr(f"shiftright(slot, {bits} - depth)")).count().collect()
    assert sum(r["count"] for r in sizes) == 500 and max(r["count"] for r in sizes) <= 20
    assert len({r.depth for r in sizes}) > 1


def test_shards(docs, rows):
    got = sorted(sharding.byte_shards(docs, 16).collect(), key=lambda r: (r.shard, r.slot))
    sizes = [len((t or "").encode()) + 1 for _, t in rows]
    assert sorted(r["size"] for r in got) == sorted(sizes)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)  # contiguous
    before = 0
    for r in got:
        assert r.shard == before * 16 // sum(sizes)
        before += r["size"]
    for s in range(16):
        slots = [r.slot for r in got if r.shard == s]
        assert slots == list(range(len(slots)))
    assert {(r.doc_id, r.text_crc32) for r in got} == {(i, zlib.crc32((t or "").encode())) for i, t in rows}
    assert {r.shard for r in sharding.byte_shards(docs, 1).collect()} == {0}


def test_pieces_are_whole_and_cut_before_space():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab1 \n'.é") for _ in range(rng.randrange(200)))
        parts = bpe.pieces(text, 7)
        assert "".join(parts) == text
        assert all(a[-1:].strip() and not b[:1].strip() for a, b in zip(parts, parts[1:]))
    assert bpe.pieces("x" * 50, 7) == ["x" * 50]


def _tokenizer():
    import public_tokenizers

    return bpe.encoding(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def test_long_runs_are_encoded_as_by_the_library():
    tokenizer = _tokenizer()
    runs = [c * 6000 for c in (" ", "\n", "a", "1", "!", "é", "\u3000", "\x1c", "\t")] + [" \n" * 3000, "\n" * 5000 + " "]
    texts = [a + run + b for run in runs for a in ("", "x", "x ", "!") for b in ("", "y", "\ny", "'s", "\x1cq")]
    texts += ["ab \x1c!" * 30_000, "\x85 \x1d" * 40_000, " " * 5000 + "a" + " " * 5000 + "b" + "\n" * 5000]
    for text in texts:
        assert np.concatenate(bpe.token_ids(tokenizer, text)).tolist() == tokenizer.encode_ordinary(text)


def test_texts_beyond_what_the_library_takes(spark):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    n = 2_000_000
    texts = [" " * n, "\n" * n, "a" * n, "x" + " " * n + "y", "\u3000" * n + "z"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    done = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    equal = F.col("decoded") == F.col("text").cast("binary")
    assert {r.equal for r in done.select(equal.alias("equal")).collect()} == {True}


def test_bpe_of_empty_tables(empty):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert bpe.decode(bpe.encode(empty, ranks, public_tokenizers.PATTERN), ranks).count() == 0


def test_bpe_round_trip(docs, rows):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    done = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in done) == sorted((i, t or "") for i, t in rows)
    one_pass = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    assert one_pass.columns == [*docs.columns, "ids", "decoded"]
    assert sorted(map(repr, one_pass.collect())) == sorted(map(repr, done))
    with pytest.raises(ValueError, match="exists"):
        bpe.encode(docs, ranks, public_tokenizers.PATTERN, ids_column="sig")


def test_language(spark):
    known = [(i, "the cat sat on the mat", "en") for i in range(30)] + [(i, "le chat est sur la table", "fr") for i in range(30, 60)]
    docs = spark.createDataFrame(known, "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    asked = [(1, "the cat"), (2, "le chat"), (3, None), (4, ""), (5, "123 !?"), (6, "cats the matter " * 3000), (7, "Tables")]
    frame_ = spark.createDataFrame([(i, t, 1) for i, t in asked], "doc_id long, text string, n int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(frame_, model).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["en", "fr", "und", "und", "und", "en", "fr"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[3][1] == 0
    nothing = langid.train(docs.where("doc_id < 0"), F.lit(True))
    assert {r.lang_pred for r in langid.identify(frame_, nothing).collect()} == {"und"}


def test_rare_languages_keep_their_words(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE", 40)
    rng = random.Random(6)
    common, rare = [f"ab{chr(97 + i)}{chr(97 + k)}" for i in range(5) for k in range(5)], ["xylo", "xyst", "aboa"]
    rows = [(i, " ".join(rng.choices(common, k=40)), "en") for i in range(2000)]
    rows += [(i, " ".join(rare + common[:1]), "fr") for i in range(2000, 2005)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = dict(langid._sampled(docs.select("doc_id", "lang"), "doc_id").groupBy("lang").count().collect())
    assert 15 < sizes["en"] < 80 and sizes["fr"] == 5
    model = langid.train(docs, F.lit(True))
    assert model.langs == ["en", "fr"] and len(model.words) == len(common) + len(rare)
    assert langid.Scorer(model).predict(["xylo aboa", "xylon"])[0] == ["fr", "fr"]
    # the word of both languages has the counts of both
    assert np.exp(model.of_words(common[:1])[0])[1] == pytest.approx((5 + langid.SMOOTH) / (20 + langid.SMOOTH * len(model.words)))


def test_language_scores_match_a_plain_loop(spark):
    """Counting, backing off and adding up again, word by word and n-gram by n-gram."""
    rng = random.Random(8)
    letters = {"en": "abcdé", "fr": "cdefß", "und?": "日本語ab"}
    vocabulary = {lang: ["".join(rng.choices(of, k=rng.randrange(1, 8))) for _ in range(40)] for lang, of in letters.items()}
    rows = [(i, lang, " ".join(rng.choices(vocabulary[lang], k=12))) for i, lang in enumerate(list(letters) * 30)]
    docs = spark.createDataFrame([(i, t, lang) for i, lang, t in rows], "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True))
    langs = sorted(letters)

    def log_frequencies(items):  # {lang: Counter of items} of one kind
        distinct = set().union(*items.values())
        return {g: [math.log((items[lang][g] + langid.SMOOTH) / (sum(items[lang].values()) + langid.SMOOTH * len(distinct))) for lang in langs] for g in distinct}

    found = {lang: Counter(w for _, of, t in rows if of == lang for w in t.split()) for lang in langs}
    known = log_frequencies(found)
    parts = {n: log_frequencies({lang: sum((Counter({g: k * c for g, c in Counter(langid.grams(w, n)).items()}) for w, k in found[lang].items()), Counter()) for lang in langs}) for n in range(1, 6)}

    def of_word(word):
        if word in known:
            return known[word]
        for n in range(5, 0, -1):
            hits = [parts[n][g] for g in langid.grams(word, n) if g in parts[n]]
            if hits:
                return [sum(h[k] for h in hits) / len(hits) for k in range(len(langs))]
        return [0.0] * len(langs)

    texts = [" ".join("".join(rng.choices("abcdéfß日本zq", k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    texts += ["½", "² ① Ⅷ", "a½b", "5", None, "", "Ω", "A" * 100_000, "ab " * 50_000]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(asked, model).collect()}
    for i, text in enumerate(texts):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        if not words:
            assert got[i] == ("und", 0.0)
            continue
        total = [sum(v) for v in zip(*map(of_word, words))]
        share = [math.exp(t - max(total)) for t in total]
        assert got[i][1] == pytest.approx(max(share) / sum(share), rel=1e-4)
        if sorted(total)[-1] - sorted(total)[-2] > 1e-3:
            assert got[i][0] == langs[total.index(max(total))]


def test_equal_language_scores_go_to_the_first(spark):
    docs = spark.createDataFrame([(1, "same words", "zz"), (2, "same words", "aa")], "doc_id long, text string, lang string")
    found = langid.identify(docs.drop("lang"), langid.train(docs, F.lit(True))).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("aa", 0.5)}


def test_a_repeated_id_is_one_sampled_text(spark):
    many = [(7, f"copy {i}") for i in range(3000)] + [(8, "a"), (9, "b")]
    docs = spark.createDataFrame(many, "doc_id long, text string")
    sample = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "doc_id long, label int")
    assert fitting.with_texts(docs, sample, "doc_id", "text").count() == 3
    twice = sample.unionByName(sample)
    assert fitting.sampled(twice, "doc_id", 10).count() == 3


def test_classifiers_on_blank_texts_and_without_labels(spark, docs, rows, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(scored) == len(rows) and {r.score for r in scored} == {0.5}
    chain = toxicity.train(docs, labels, ["toxic"])
    assert {r.p_toxic for r in toxicity.score(docs, chain, ["toxic"]).collect()} == {0.0}
    labels = spark.createDataFrame([(i, i % 2, None if i == 3 else i % 2) for i in range(100)], labels.schema)
    assert quality.score(docs, quality.train(docs, labels)).where("score between 0 and 1").count() == len(rows)
    chain = toxicity.train(docs, labels, ["toxic"])
    assert toxicity.score(docs, chain, ["toxic"]).where("p_toxic between 0 and 1").count() == len(rows)


def test_linear_model_is_fitted_to_the_end():
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 400)
    docs = [np.array([k, 2 + (k ^ 1) if rng.random() < 0.02 else 2 + k]) for k in labels]
    p = toxicity.Linear(docs, np.zeros((400, 0)), labels.astype(float)).probability(docs, np.zeros((400, 0)))
    assert -np.log(np.where(labels == 1, p, 1 - p)).mean() < 0.02


def test_chain_feeds_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 300)
    docs = [np.unique(np.append(rng.integers(10, 400, 5), [1] if f else [2])) for f in first]
    labels = np.column_stack([first, first])
    chain = toxicity.fit_chain(docs, labels, np.arange(300) % 3)
    assert chain[1].dense[0] > 0  # the second category leans on the first
    found = toxicity.run_chain(chain, docs)
    assert ((found[:, 1] > 0.5) == first).mean() > 0.97


def test_language_model(docs, rows, spark):
    got = lm.text_scores(docs, F.col("doc_id") % 4 != 1).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert by[0][0].n_tokens == 1 and by[0][0].bits_per_byte is None
    learnt = [r.bits_per_byte for r in got if r.n_bytes > 200]
    assert np.mean(learnt) < 3  # far below the 8 bits of a model that knows nothing
    nothing = lm.text_scores(docs, F.lit(False)).where("doc_id = 1").first()
    assert nothing.train_tokens == 0 and nothing.score == pytest.approx(-8 * np.log10(2))


def test_bits_are_a_distribution():
    """Over all values of the next byte the probabilities add up to one."""
    contexts = b"the the tho thu"
    keys, _ = lm.grams([contexts])
    mixer = lm.Mixer(lm.learn(*(lambda k, n: (k, n))(*np.unique(keys, return_counts=True))))
    asked = np.unique(np.concatenate([keys, (keys[5] & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)]))
    counts = np.array([(keys == k).sum() for k in asked])
    logs = mixer.log10(asked, counts)
    same = (asked >> np.uint64(8)) == keys[5] >> np.uint64(8)
    assert (10.0 ** logs[same]).sum() == pytest.approx(1)


@pytest.mark.parametrize(
    "operator",
    [
        lambda e: ngram_join.alike(e),
        lambda e: decontaminate.contained_items(e, e.withColumnRenamed("doc_id", "item_id")),
        lambda e: lm.text_scores(e, F.lit(True)),
        lambda e: substring.repeated_passages(e),
        lambda e: sharding.byte_shards(e),
        lambda e: exact_dedup.exact_duplicates(e),
        lambda e: langid.identify(e, langid.train(e, F.lit(True))),
    ],
)
def test_empty_tables(empty, operator):
    assert operator(empty).count() == 0


def test_null_ids(spark, rows):
    """Rows without an id take part, and never win over rows with one."""
    docs = frame(spark, [(None, rows[8][1]), (None, None), (7, rows[8][1]), (9, rows[8][1] + " end")])
    kept = {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert kept == {(None, 7, False), (None, None, True), (7, 7, True), (9, 9, True)}
    linked = {(r.doc_id, r.component_id) for r in ngram_join.alike(docs).collect()}
    assert linked == {(None, 7), (None, None), (7, 7), (9, 7)}
    gone = {(r.doc_id, len(r.spans)) for r in substring.repeated_passages(docs).collect()}
    assert gone == {(None, 0), (7, 0), (9, 1)}
    assert [r.doc_id for r in sharding.byte_shards(docs, 2).orderBy("shard", "slot").collect()] == [None, None, 7, 9]
    assert lm.text_scores(docs, F.lit(True)).count() == 4
    items = spark.createDataFrame([(1, rows[8][1])], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contained_items(docs, items).collect()} == {7, 9}
