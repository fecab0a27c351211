"""The whole pipeline against a plain-Python twin, stage by stage, on planted documents; long texts and empty tables of the operators."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from stratum.llm import bpe, common, embdup, packing, quality, simhash, suffix, tokcount, toxicity, urlfilter, warc
from stratum.llm.bpe_tables import default_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(rows):
    def good(text):
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        seen = collections.Counter(windows)
        repeat = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
        chars = sum(map(len, words))
        found = {"n_words": len(words), "mean_word_chars": chars / max(len(words), 1), "symbol_ratio": len(re.findall(r"[#*$%&|<>]", text)) / max(chars, 1),
                 "dup_line_ratio": (len(lines) - len(set(lines))) / max(len(lines), 1),
                 "shout_ratio": len(re.findall(r"[A-Z]{2}", text)) * 2 / max(chars, 1),
                 "stop_word_ratio": sum(w in quality.CASED for w in words) / max(len(words), 1)}
        if len(words) < 50 or 100 * len(repeat) > 50 * len(words):
            return False
        return all(len(words) < least or ((low is None or found[m] >= low) and (high is None or found[m] <= high))
                   for m, low, high, least in quality.RULES)

    return [r for r in rows if good(r["text"])]


def plain_toxicity(rows, model):
    def severity(text):
        count = collections.Counter()
        for w in re.findall(r"[^\W\d_]+", (text or "").lower()):
            count[w] += 1
            for k in range(3, 9):
                if len(w) > k:
                    count[w[:k] + "*"] += 1
        score = sum(model.weights.get(f, 0.0) + (model.weights.get(f + "2", 0.0) if n > 1 else 0.0) for f, n in count.items())
        return sum(1 / (1 + np.exp(t - score)) for t in model.thresholds)

    return [r for r in rows if severity(r["text"]) < model.limit]


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_simhash(rows):
    prints = [plain_fingerprint(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[find(i)].append(r)
    digest = lambda t: int(np.uint64(xxhash.xxh64_intdigest((t or "").encode(), 42)).view(np.int64))
    return [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, digest(r["text"]))) for g in groups.values()]


def plain_suffix(rows, length=200):
    raw = [(r["text"] or "").encode() for r in rows]
    seen = collections.Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        text = bytes(x for x, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        out.append({**r, "text": text, "n_chars": len(text)})
    return out


def planted():
    """(rows, labels, names of the planted rows: what must stay and what must go)."""
    rng = random.Random(21)
    common_words, stop = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 9))) for _ in range(900)], "the of and to in is that for with".split()
    bad = ["".join(rng.choices("qwkvxz", k=6)) for _ in range(6)]

    def clean(n):
        return ". ".join(" ".join(rng.choice(stop) if rng.random() < 0.3 else rng.choice(common_words) for _ in range(10)) for _ in range(n // 10)) + "."

    def toxic(n):
        return " ".join(rng.choice(bad) if rng.random() < 0.15 else w for w in clean(n).split(" "))

    texts, labels, role = {}, {}, collections.defaultdict(set)
    for i in range(120):
        texts[i], labels[i] = clean(rng.randint(60, 250)), 0
        role["stay"].add(i)
    for i in range(120, 200):
        texts[i], labels[i] = toxic(rng.randint(60, 250)), 1
        role["go"].add(i)
    passage = clean(70)
    for i in range(200, 206):  # a passage of over fifty words that documents share
        texts[i] = clean(60) + "\n" + passage + "\n" + clean(60)
        role["stay"].add(i)
        role["shared"].add(i)
    for i in range(210, 215):  # exact copies of clean documents
        texts[i] = texts[i - 210]
        role["go"].add(i)
    for i in range(220, 240):  # copies with one word changed: linked or not as the bits fall
        words = texts[i - 200].split(" ")
        words[len(words) // 2] = "changed"
        texts[i] = " ".join(words)
    texts |= {250: "too short", 251: "", 252: None, 253: "over and over and " * 60, 254: clean(60).replace("e", "#").replace("o", "%"), 255: "é日本 " + clean(2000)}
    role["go"] |= {250, 251, 252, 253, 254}
    role["stay"].add(255)
    rows = [dict(doc_id=i, text=t, lang="en", source=f"s{i % 3}", n_chars=None if t is None else len(t)) for i, t in texts.items()]
    rows += [dict(rows[10]), dict(rows[10]), {**rows[11], "doc_id": None}, {**rows[0], "doc_id": None, "text": clean(100)}, {**rows[12], "text": clean(100)}]
    return rows, labels, role, passage


def key(r):
    return str((r["doc_id"], r["text"], r["source"], r["n_chars"]))


def test_pipeline_equals_its_plain_twin(spark, tmp_path):
    rows, labels, role, passage = planted()
    sf = str(tmp_path)
    spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA).repartition(5).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert model.weights
    twins = {"quality": plain_quality, "toxicity": lambda x: plain_toxicity(x, model), "simhash": plain_simhash, "suffix_array": plain_suffix}
    docs, plain = spark.read.parquet(f"{sf}/documents.parquet"), rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, plain = common.table(stage(spark, docs, sf), f"twin-{name}"), twins[name](plain)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = [r.asDict() for r in docs.collect()]
        assert sorted(map(key, got)) == sorted(map(key, plain)), name
    left = {r["doc_id"] for r in plain}
    assert not role["stay"] - left and not role["go"] & left, (role["stay"] - left, role["go"] & left)
    assert sum(r["doc_id"] == 10 for r in plain) == 1 and sum(r["doc_id"] is None for r in plain) == 1
    assert not any(passage in r["text"] or passage[5:250] in r["text"] for r in plain if r["doc_id"] in role["shared"])
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    want = collections.Counter((r["doc_id"], len(library.encode(r["text"], add_special_tokens=False).ids) + 1) for r in plain)
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == want
    at = 0
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert divmod(at, 2048) == (r.sequence_id, r.offset)
        at += r.length
    assert at == sum(n * k for (_, n), k in want.items())


def test_pipeline_of_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_operators_on_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    model = toxicity.Ordinal({"bad": 3.0}, [1.0, 2.0])
    for made in (tokcount.token_counts(docs), toxicity.score(docs, model), toxicity.keep_clean(docs, model), simhash.near_duplicates(docs),
                 packing.pack(docs), suffix.dedup(docs), quality.quality(docs), quality.keep_good(docs), bpe.round_trip(docs),
                 embdup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")),
                 urlfilter.filter_urls(spark.createDataFrame([], "page_id long, url string"), [("block", "a.b", "/")]),
                 warc.archive(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert made.count() == 0


def test_operators_on_a_very_long_text(spark):
    """Three million bytes, no two 3-word windows alike but for one planted line."""
    rng = random.Random(30)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(430_000)]
    words[1000:1040] = words[300_000:300_040]
    text = "the " + " ".join(words)
    docs = spark.createDataFrame([(1, text, "x", "y", 0), (2, None, "x", "y", 0)], SCHEMA)
    judged = {r.doc_id: r for r in quality.quality(docs).collect()}
    assert judged[1].n_words == 430_001 and judged[1].n_repeat_words == 80 and judged[1].word_chars == 430_000 * 6 + 3 and not judged[2].kept
    print_ = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert print_ == {1: f"{plain_fingerprint(text):016x}", 2: "0" * 16}
    raw = text.encode()
    first, second = raw.index(" ".join(words[1000:1040]).encode()), raw.rindex(" ".join(words[1000:1040]).encode())
    size = 40 * 7 - 1
    cut = {r.doc_id: r for r in suffix.dedup(docs, with_kept=True).collect()}
    own = cut[1]
    assert own.n_bytes == len(raw) and own.n_spans == 2 and 2 * size <= own.n_removed <= 2 * size + 4 * 7
    assert first - 7 <= 7 * 1000 + 4 <= first and second > first and own.kept_sha256 == hashlib.sha256(bytes(own.kept)).hexdigest()
    model = toxicity.Ordinal({words[-1]: 9.0}, [1.0])
    assert [r.toxic for r in toxicity.score(docs, model, limit=0.5).orderBy("doc_id").collect()] == [True, False]
    pages = spark.createDataFrame([(1, "http://a/", text), (2, None, text)], "page_id long, url string, html string")
    archived = {r.page_id: r for r in warc.archive(pages).collect()}
    assert archived[1].refers_to == 2 and archived[2].payload_digest == hashlib.sha1(raw).hexdigest() and archived[2].payload_bytes == len(raw)


def test_toxicity_fit_is_the_likelihood_maximum():
    """The gradient of the ridged likelihood, by finite differences of a plain formula, vanishes where training ends."""
    rng = np.random.RandomState(3)
    x = (rng.rand(400, 6) < 0.4).astype(np.float32)
    latent = x @ np.array([2.0, 1.0, -1.5, 0.5, 0.0, -0.5]) + rng.logistic(size=400)
    y = np.digitize(latent, [0.5, 2.0])
    w, t = toxicity.train(x, y, 3, ridge=1e-3, rounds=4000, rate=0.02)

    def loss(p):
        s, cut = x.astype(float) @ p[:6], p[6:]
        above = 1 / (1 + np.exp(-(s[:, None] - cut)))  # chance to lie above each threshold
        chance = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], axis=1)
        return -np.log(chance[np.arange(len(y)), y]).mean() + 1e-3 / 2 * (p[:6] ** 2).sum()

    best = np.concatenate([w, t])
    steps = np.eye(8) * 1e-5
    gradient = np.array([(loss(best + s) - loss(best - s)) / 2e-5 for s in steps])
    assert abs(gradient).max() < 1e-3 and t[0] < t[1]
    assert all(loss(best + 0.05 * rng.normal(size=8)) > loss(best) for _ in range(50))


@pytest.mark.parametrize("text", ["", "One", "one two", "ÉCOLE École a b c", "A b\tC\nd  e\x0bf", "x y " * 3000])
def test_fingerprints_equal_a_plain_count(text):
    assert simhash.fingerprint(re.sub("[A-Z]", lambda m: m[0].lower(), text).encode()) == plain_fingerprint(text) == simhash.fingerprint(text.encode())


def test_random_fingerprints_and_quality(spark):
    rng = random.Random(40)
    texts = ["".join(rng.choice(["a", "B", "the ", "of ", " ", "\n", "#", "É", "日", "c d e "]) for _ in range(rng.randint(0, 400))) for _ in range(400)]
    assert all(simhash.fingerprint(t.encode()) == plain_fingerprint(t) for t in texts)
    rows = [dict(doc_id=i, text=t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(r["doc_id"], r["text"], 0) for r in rows], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in quality.quality(df).collect()}
    assert {i for i, r in got.items() if r.kept} == {r["doc_id"] for r in plain_quality(rows)}
    for i, t in enumerate(texts):
        words = WORD.findall(t)
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        seen = collections.Counter(windows)
        assert got[i].n_repeat_words == len({k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)})
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_dup_lines) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
