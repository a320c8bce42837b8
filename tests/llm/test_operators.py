"""Each operator against a plain brute-force version, on the small tables and on awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from public_tokenizers import PATTERN, path
from tidefold.llm import bpe, edit_fingerprint, html_text, packing, quality, quality_rules, secret_scan, simhash, toxicity, url_filter
from tidefold.llm.queries import oracle_sql, queries

SMALL = "/root/testdata/sf0.001"
AWKWARD = [
    (1, None), (2, ""), (3, " "), (4, "\n\n"), (None, "one two"), (5, "a"), (5, "a"), (6, "  leading and  double \n spaces \n"),
    (7, "x" * 5000 + " " + "y z " * 3000), (8, "é ü \u3000 wide\u00a0space 中文字 👍🏽 e\u0301"), (9, "password=hunter22 token: abc secret = 'zzzzzzzz'"),
    (10, "The The The The " * 40), (11, "a"), (None, None), (12, "tab\tand\x0bvt\x1c fs \x85 nel don't we'LL 1234567 !!! ..."),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows with columns whose names clash with the operators' own."""
    rows = [(i, t, "x", 1.5, "y", 3) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, score double, text__ string, n int")


@pytest.fixture(scope="module")
def docs(spark, odd):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text")).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, fp string, score double")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def counted(rows):
    return collections.Counter(rows)


# --- secret scans


def base_spans(text):
    found = []
    for m in re.finditer(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secret_base(spark, docs):
    got = secret_scan.secret_digest(docs).collect()
    kinds = ("assign", "access", "hex")
    want = []
    for i, t in rows_of(docs):
        s = base_spans(t or "")
        text = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s)
        want.append((i, *(sum(k == n for _, k, _ in s) for n in range(3)), hashlib.sha256(text.encode()).hexdigest()))
    assert counted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in got) == counted(want)
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got) >= 2


def test_secret_many_and_links(spark):
    texts = [
        "password=abcdef " * 300,
        "token=x: abcdefgh password=token: abcdefgh 😀 secret:'q1w2e3r4'",
        "user: alice\nkey = Zm9vYmFyYmF6\nhttps://db.example.com/x",
        "user: alice\n\nkey = Zm9vYmFyYmF6",
        "only https://example.com/page here",
        "user: alice " + "z" * 400 + " key = Zm9vYmFyYmF6",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r for r in secret_scan.secret_digest(df).collect()}
    assert got[0]["n_assign"] == 300 and got[0]["spans"].endswith(f"assign:{16 * 299}:{16 * 299 + 15}")
    kinds = ("assign", "access", "hex")
    for k in (0, 1):
        assert [x for x in got[k]["spans"].split(",") if x.split(":")[0] in kinds] == [f"{kinds[c]}:{a}:{b}" for a, c, b in base_spans(texts[k])]
    assert [x.split(":")[0] for x in got[2]["spans"].split(",")] == ["ident", "weak", "endpoint"]
    assert got[3]["spans"] == got[4]["spans"] == got[5]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact_secrets(df).collect()}
    assert clean[2] == "[secret]\n[secret]\n[secret]" and clean[4] == texts[4] and "abcdef" not in clean[0]


def linked_spans(text):
    """Base spans and linked weak spans by the definition."""
    base = base_spans(text)
    found = [(s, k, e) for s, k, e in base]
    for kind, pattern in ((3, secret_scan.IDENT), (4, secret_scan.WEAK), (5, secret_scan.ENDPOINT)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.A)]
    blanks = [m.start() for m in re.finditer(secret_scan.BLANK, text)]
    scope = lambda at: sum(b < at for b in blanks)
    out = set(base)
    for s, k, e in found:
        if k < 3 or any(a < e and s < b for a, _, b in base):
            continue
        near = {kind for a, kind, _ in found if abs(a - s) <= secret_scan.WINDOW and scope(a) == scope(s)}
        secret, ident, endpoint = bool(near & {0, 2, 4}), bool(near & {1, 3}), 5 in near
        if {3: secret, 4: ident or endpoint, 5: secret and ident}[k]:
            out.add((s, k, e))
    return sorted(out)


def test_secret_links_by_definition(spark):
    rng = random.Random(31)
    bits = [
        "user: alice", "client_id=ab12cd", "login = bob", "key = Zm9vYmFyYmF6", "pwd: hunter2222", "auth=0123456789", "https://db.example.com/x", "s3://bucket/some/path",
        "password=secret99", "token: abcdefgh", "AKIA" + "A1" * 9, "deadbeef" * 4, "password=" + "x" * 300 + "key=abcdefghij", "https://h.example/?password=abcdefg&q=" + "y" * 300, "\n\n", "\n \t\n", "\n",
        "plain words", "z" * 120, "\u00e9\U0001F600", " ", "; ",
    ]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", "\n", "; "]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts.append("user: alice key = Zm9vYmFyYmF6\n" * 2000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["spans"] for r in secret_scan.secret_digest(df).collect()}
    kinds = secret_scan.KINDS
    for i, t in enumerate(texts[:-1]):
        assert got[i] == ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in linked_spans(t)), t
    assert got[300].count("ident") == got[300].count("weak") == 2000
    assert any("endpoint" in x for x in got.values())


# --- byte-level BPE


def reference_encoding():
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_library(docs):
    own = reference_encoding()
    got = bpe.bpe_digest(docs, path("byte_bpe_multi_50k.tiktoken"), PATTERN).collect()
    want = []
    for i, t in rows_of(docs):
        ids = own.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert counted(map(tuple, got)) == counted(want)


def test_bpe_queue_on_long_pieces_and_white_space():
    own = reference_encoding()
    e = bpe.Encoder(bpe.load_ranks(path("byte_bpe_multi_50k.tiktoken")), PATTERN)
    rng = random.Random(3)
    for n in (3, 50, 700, 20_000):
        text = "".join(rng.choice("abcdeé") for _ in range(n)) + "aaaa" * n
        assert e.encode(text) == own.encode_ordinary(text)
    for _ in range(3000):
        text = "".join(rng.choice(" \n\tab,'s1\u00a0\x1c\x85é") for _ in range(rng.randrange(14)))
        assert e.encode(text) == own.encode_ordinary(text), repr(text)
    spaces = "".join(f"a{chr(c)}b" for c in range(0x3100) if chr(c).isspace() or c < 33)
    assert e.encode(spaces) == own.encode_ordinary(spaces)


def test_bpe_round_trip(odd):
    coded = bpe.encode_texts(odd, path("byte_bpe_multi_50k.tiktoken"), PATTERN)
    back = bpe.decode_ids(coded, path("byte_bpe_multi_50k.tiktoken"))
    assert back.columns == [*odd.columns, "ids", "decoded"]
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back.collect())


# --- SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items, close):
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if close(items[i], items[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def test_simhash_components(docs):
    rows = rows_of(docs)
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    low = {}
    for (i, _), r in zip(rows, roots, strict=True):
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    want = counted((i, f"{p:016x}", low[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))
    got = simhash.simhash_digest(docs)
    assert counted(map(tuple, got.collect())) == want


def test_simhash_chains_and_large_buckets(spark, monkeypatch):
    from tidefold.llm import _links

    monkeypatch.setattr(_links, "CHUNK", 8)
    base = 0x0123456789ABCDEF
    chain = [base]
    for k in range(60):
        chain.append(chain[-1] ^ (7 << (k % 20) * 3))
    near = [base ^ (1 << i) for i in range(40)]
    values = sorted({v - (1 << 64) if v >> 63 else v for v in [*chain, *near, 5, 1 << 40]})
    edges = _links.near_links(spark.createDataFrame([(v,) for v in values], "fp long"))
    roots = {r["node"]: r["root"] for r in _links.components(edges).collect()}
    want = brute_components(values, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    groups = collections.defaultdict(set)
    for v, r in zip(values, want, strict=True):
        groups[r].add(v)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {
        frozenset(n for n in roots if roots[n] == r) for r in set(roots.values())
    }


def test_simhash_keeps_one(spark, odd):
    kept = simhash.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())[:3] == [1, 5, 5]


# --- URL filters


def test_url_filter_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SMALL}/pages.parquet'")
    want = con.sql(oracle_sql()["op4_url_filter"]).fetchall()
    got = url_filter.url_verdicts(spark.read.parquet(f"{SMALL}/pages.parquet"))
    assert counted(map(tuple, got.collect())) == counted(want)


def test_url_cases(spark):
    urls = [None, "", "no scheme", "http://X.ORG", "http://x.ORG/", "a://b.example.org/es/1", "a://example.org/en/12?q", "a://forg/", "a://com/fr/", "x://y.com/de/#z", "http://www.ads-track.example.com/en", "http://notads-track.example.com/a", "http://.example.com"]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id int, url string, host string, verdict string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df).orderBy("page_id").collect()]
    assert got == [
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("x.org", "", None, "allow"), ("x.org", "/", "org/", "allow"),
        ("b.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("forg", "/", None, "allow"),
        ("com", "/fr/", "com/fr/", "allow"), ("y.com", "/de/", "com/de/", "block"), ("www.ads-track.example.com", "/en", None, "block"),
        ("notads-track.example.com", "/a", None, "allow"), (".example.com", "", None, "allow"),
    ]
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_cascade_is_exact(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 3)
    monkeypatch.setattr(url_filter, "HASHES", 2)
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where(F.xxhash64("key") % 7 == 0)
    names = {r[0] for r in listed.collect()}
    (whole,) = url_filter.build_cascades(universe, listed)
    assert len(whole.levels) > 2 and all(whole.lists(f"k{i}") == (f"k{i}" in names) for i in range(3000))
    shards = list(url_filter.build_cascades(universe, listed, 100))
    assert len(shards) > 2 and all(c.n_bytes <= 108 for c in shards)
    assert all(any(c.lists(f"k{i}") for c in shards) == (f"k{i}" in names) for i in range(3000))


def test_url_filter_beyond_the_bound_of_a_broadcast(spark, monkeypatch):
    hosts = [f"{'www.' * (k % 2)}h{k}.example.com" for k in range(300)]
    rows = [(i, f"http://{h}/p{i}", "extra") for i, h in enumerate([*hosts, *["h1.example.com"] * 200, None, ""])]
    df = spark.createDataFrame(rows, "page_id int, url string, salt string")
    listed = [f"h{k}.example.com" for k in range(0, 300, 3)]
    want = url_filter.filter_urls(df, rules=(), listed=listed).collect()
    assert sum(r["verdict"] == "block" for r in want) == 100
    monkeypatch.setattr(url_filter, "MAX_BYTES", 40)
    got = url_filter.filter_urls(df, rules=(), listed=listed)
    assert counted(map(tuple, got.select(*df.columns, "host", "path", "rule", "verdict").collect())) == counted(
        (*(r[c] for c in df.columns), r["host"], r["path"], r["rule"], r["verdict"]) for r in want
    )


# --- classifiers


def accuracy(con, scores, label):
    con.register("s", scores.toPandas())
    return con.sql(
        f"select avg((s.predicted = l.{label})::int), sum((s.predicted = 0 and l.{label} = 1)::int)::int, count(*) from s join '/root/testdata/sf0.01/labels.parquet' l using (doc_id) where held_out"
    ).fetchall()[0]


def test_quality_held_out(spark):
    got = queries()["op6_quality"](spark, "/root/testdata/sf0.01")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got.collect())
    right, lost, n = accuracy(duckdb.connect(), got, "quality")
    assert right >= 0.97 and lost <= 1 and n > 100, (right, lost, n)


def test_toxicity_held_out(spark):
    got = queries()["op5_toxicity"](spark, "/root/testdata/sf0.01")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got.collect())
    right, _, n = accuracy(duckdb.connect(), got, "toxic")
    assert right >= 0.9 and n > 60, (right, n)


def test_classifiers_on_awkward_rows(spark, odd, empty):
    labels = spark.createDataFrame([(7, 1, 0), (9, 0, 1), (10, 0, None), (None, 1, 1), (10, 1, 1)], "doc_id long, quality int, toxic int")
    for fit, score in ((quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)):
        for some in (labels, labels.limit(0)):
            model = fit(odd, some)
            got = score(odd, model)
            assert got.count() == odd.count() and got.where("score is null or predicted is null").count() == 0
        assert score(empty, fit(empty, labels.limit(0))).count() == 0


def test_toxicity_patterns_allow_any_white_space():
    voters = toxicity.make_voters([])
    first = voters.n_marks
    for text in ("u are stupid", "u\nare stupid", "U\tr pathetic", "you\nare a loser"):
        assert voters.counts(text).get(first) == 1, text


def test_toxicity_finds_most_toxic_texts(spark):
    con = duckdb.connect()
    con.register("s", queries()["op5_toxicity"](spark, "/root/testdata/sf0.1").toPandas())
    found, toxic, wrong, clean = con.sql(
        "select sum((toxic = 1 and predicted = 1)::int), sum((toxic = 1)::int), sum((toxic = 0 and predicted = 1)::int), sum((toxic = 0)::int) "
        "from s join '/root/testdata/sf0.1/labels.parquet' using (doc_id) where held_out"
    ).fetchall()[0]
    assert found >= 0.9 * toxic > 80 and wrong <= 0.01 * clean, (found, toxic, wrong, clean)


def test_label_model_against_single_votes():
    """Posteriors and rates by the definition, text by text and voter by voter."""
    rng = np.random.default_rng(3)
    truth = rng.random(400) < 0.2
    rate = np.where(truth[:, None], [[0.5, 0.4, 0.4, 0.02]], [[0.02, 0.03, 0.02, 0.6]])
    votes = (rng.random((400, 4)) < rate).astype(float)
    votes[:, 2] = np.where(rng.random(400) < 0.9, votes[:, 1], votes[:, 2])  # goes with the one before
    labels = np.where(rng.random(400) < 0.05, ~truth, truth).astype(int)
    model = toxicity.fit_label_model(votes, labels, 3)
    got = model.posterior(votes, labels)
    for r in range(400):
        odds = np.log(model.prior / (1 - model.prior))
        a, b = model.label
        odds += np.log(a / b) if labels[r] else np.log((1 - a) / (1 - b))
        for k in range(4):
            if votes[r, k]:
                sharing = max(1.0, sum(model.overlap[j, k] for j in range(4) if votes[r, j]))
                odds += np.log(model.on_toxic[k] / model.on_clean[k]) / sharing
        assert got[r] == pytest.approx(1 / (1 + np.exp(-odds)))
    assert model.overlap[1, 2] > 0.3 > model.overlap[0, 1]
    assert ((got >= 0.5) == truth).mean() > 0.97
    assert np.allclose(model.on_toxic[:3], (got @ votes[:, :3] + 0.05) / (got.sum() + 0.5), atol=1e-3)


def test_ftrl_by_definition():
    """Sparse updates against the same rule applied coordinate by coordinate."""
    from tidefold.llm._linear import Ftrl

    rng = np.random.default_rng(4)
    model, z, n, z0, n0 = Ftrl(12), [0.0] * 12, [0.0] * 12, 0.0, 0.0
    a, b, l1, l2 = model.alpha, model.beta, model.l1, model.l2

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((b + n[i] ** 0.5) / a + l2)

    for _ in range(200):
        i = rng.choice(12, rng.integers(0, 6), replace=False)
        x, y, k = rng.random(len(i)), float(rng.integers(0, 2)), rng.random() * 2
        bias = -z0 / ((b + n0**0.5) / a)
        g = k * (1 / (1 + np.exp(-(bias + sum(weight(j) * v for j, v in zip(i, x, strict=True))))) - y)
        for j, w, v in [(j, weight(j), v) for j, v in zip(i, x, strict=True)]:
            z[j] += g * v - ((n[j] + (g * v) ** 2) ** 0.5 - n[j] ** 0.5) / a * w
            n[j] += (g * v) ** 2
        z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / a * bias
        n0 += g * g
        model.learn(i, x, y, k)
    assert np.allclose(model.weights(), [weight(i) for i in range(12)]) and model.bias == pytest.approx(-z0 / ((b + n0**0.5) / a))


def test_labelled_rows_are_bounded_for_repeated_ids(spark):
    rows = [(1, f"text {k}") for k in range(50)] + [(2, None), (3, "c"), (4, "d")]
    some = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 5)], "doc_id long, quality int")
    got = quality.labelled_texts(some, labels, "quality", 1, 1, 4).collect()
    assert sorted(map(tuple, got)) == [(1, "text 0", 1), (2, None, 1), (3, "c", 1), (4, "d", 1)]


# --- quality rules


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def test_quality_rules(docs):
    got = quality_rules.judge_quality(docs).collect()
    want = counted((i, *brute_measures(t)) for i, t in rows_of(docs))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert counted(tuple(r[n] for n in names) for r in got) == want
    assert all(r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5) for r in got)


def test_variety_reads_the_whole_text(spark, docs):
    rng = random.Random(4)
    ordinary = [f"word{k}" for k in range(400)]
    tiny = [rng.choice("abcdefghij") * 3 for _ in range(6000)]
    rows = [(1, " ".join(ordinary + tiny)), (2, " ".join(tiny[:400] + [f"{w}{k}" for k in range(15) for w in ordinary])), (3, " ".join(ordinary * 15))]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["vote"] for r in quality_rules.measures(made).select("doc_id", quality_rules.votes().substr(4, 1).alias("vote")).collect()}
    assert got == {1: "b", 2: "-", 3: "-"}
    both = docs.unionByName(made)
    want = []
    for i, t in rows_of(both):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        want.append((i, sum(len(set(words[k : k + 400])) for k in range(0, len(words), 400))))
    assert counted(map(tuple, quality_rules.measures(both).select("doc_id", "n_distinct").collect())) == counted(want)


def plain_estimate(rows, rounds=100):
    """Expectation-maximisation over single texts, by the definition of a latent class model."""
    q = np.array([0.05 if "b" in r else 0.95 for r in rows])
    votes = np.array([list(r) for r in rows])
    for _ in range(rounds):
        prior = (q.sum() + 8.5) / (len(rows) + 10)
        good = {v: (((votes == v) * q[:, None]).sum(0) + 0.5) / (q.sum() + 1.5) for v in "bg-"}
        bad = {v: (((votes == v) * (1 - q)[:, None]).sum(0) + 0.5) / ((1 - q).sum() + 1.5) for v in "bg-"}
        bad["b"], good["g"] = np.maximum(bad["b"], good["b"]), np.maximum(good["g"], bad["g"])
        like = [np.prod(sum((votes == v) * c[v] for v in "bg-"), axis=1) for c in (good, bad)]
        new = prior * like[0] / (prior * like[0] + (1 - prior) * like[1])
        done = np.abs(new - q).max() < 1e-6
        q = new
        if done:
            break
    return q


def test_rule_estimates_against_single_texts():
    rng = random.Random(9)
    rows = []
    for _ in range(1500):
        good = rng.random() < 0.85
        tests = ["b" if rng.random() < (0.01 if good else 0.35) else "-" for _ in quality_rules.TESTS]
        rows.append("".join([*tests, *("g" if rng.random() < (0.97 if good else 0.4) else "-" for _ in quality_rules.SIGNS)]))
    model = quality_rules.estimate(collections.Counter(rows))
    want = plain_estimate(rows)
    assert max(abs(quality_rules.posterior(r, model) - w) for r, w in zip(rows, want, strict=True)) < 1e-9
    assert 0.8 < model[0] < 0.9
    nothing = quality_rules.estimate({})
    assert nothing[0] == 0.85 and quality_rules.posterior("-" * len(quality_rules.RULES), nothing) == pytest.approx(0.85)


def test_rule_verdicts_reject_junk_that_passes_the_base(spark):
    rows = duckdb.connect()
    got = queries()["op7_quality_rules"](spark, "/root/testdata/sf0.01").select("doc_id", "base_failed", "kept").toPandas()
    rows.register("got", got)
    lost, junk, kept, good = rows.sql(
        "select sum((quality = 0 and not kept)::int), sum((quality = 0)::int), sum((quality = 1 and kept)::int), sum((quality = 1)::int) "
        "from got join '/root/testdata/sf0.01/labels.parquet' using (doc_id) where not base_failed"
    ).fetchall()[0]
    assert lost >= 0.9 * junk > 20 and kept >= 0.99 * good > 300, (lost, junk, kept, good)


def test_windows_of_equal_hash_are_told_apart(spark, docs, monkeypatch):
    """With a hash of two values, nearly all windows collide; the count stays exact."""
    from pyspark.sql import functions as F

    few = docs.where("length(text) < 3000").limit(60)
    want = counted((i, brute_measures(t)[4]) for i, t in rows_of(few))
    plain = F.xxhash64
    monkeypatch.setattr(quality_rules.F, "xxhash64", lambda *c: F.pmod(plain(*c), F.lit(2)))
    assert counted(map(tuple, quality_rules.measures(few).select("doc_id", "n_repeat_words").collect())) == want


# --- packing


def test_packing(spark, docs):
    got = packing.pack_documents(docs, path("byte_bpe_50k.json")).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    want = []
    for i, text in rows_of(docs):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want.append((i, k, a, b - a, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:b]))))
    assert counted(tuple(r)[:5] for r in got) == counted(want)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 2048) + 2


def test_packing_ids_are_those_of_the_tokenizer_file():
    from tokenizers import Tokenizer

    file = path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True
    encode = packing.encoder(file)
    assert len(packing.ranks_of(file)) == 50256 and packing.ranks_of(path("word_bpe_49k.json")) is None
    rng = random.Random(8)
    kinds = ["a", "the ", "é", " ", "  ", "\n", "\r\n", "\t", "12", "'s", "'LL", "\u00a0", "\u0085", "\u2028", "中", "😀", "\x00", "\x1c", "<|endoftext|>", "--"]
    texts = ["".join(rng.choices(kinds, k=rng.randint(0, 60))) for _ in range(400)]
    for text in [None, "", "ab" * 50_000, " \n" * 1_000_000, *texts]:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert encode(text) == np.array(want, "<u4").tobytes()


def test_packing_plans_are_whole_and_tight():
    rng = random.Random(5)
    for capacity in (10, 37, 100):
        for _ in range(60):
            counts = collections.Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 300)))
            before = dict(counts)
            rows = packing.plan(counts, capacity)
            bins, ranks = collections.defaultdict(list), collections.defaultdict(set)
            for s, first, n, sequence, offset in rows:
                for k in range(n):
                    bins[sequence + k].append((offset, s))
                    assert first + k not in ranks[s]
                    ranks[s].add(first + k)
            assert {s: len(r) for s, r in ranks.items()} == before and all(r == set(range(len(r))) for r in ranks.values())
            for places in bins.values():
                assert sum(s for _, s in places) <= capacity
            low = -(-sum(s * n for s, n in before.items()) // capacity)
            assert low <= len(bins) <= 1.23 * max(low, sum(n for s, n in before.items() if 2 * s > capacity)) + 1


def test_packing_reduction_goes_on_past_a_piece_it_cannot_fix():
    counts = {7: 1, 5: 2, 1: 2}
    assert packing.reduce_by_dominance(counts, 10) == [((5, 5), 1)] and counts == {7: 1, 5: 0, 1: 2}


def fewest_bins(sizes, capacity):
    """Fewest bins, by trying the bins' contents for the largest piece left."""
    sizes = tuple(sorted(sizes, reverse=True))
    if not sizes:
        return 0
    best = len(sizes)
    for mask in range(1 << (len(sizes) - 1)):
        rest, used = [], sizes[0]
        for k, s in enumerate(sizes[1:]):
            if mask >> k & 1:
                used += s
            else:
                rest.append(s)
        if used <= capacity:
            best = min(best, 1 + fewest_bins.cached(tuple(rest), capacity))
    return best


fewest_bins.cached = __import__("functools").cache(fewest_bins)


def test_packing_reduction_never_costs_a_bin():
    rng = random.Random(14)
    for _ in range(250):
        capacity = rng.choice([10, 13, 20])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        counts = dict(collections.Counter(sizes))
        fixed = packing.reduce_by_dominance(counts, capacity)
        rest = tuple(sorted((s for s, n in counts.items() for _ in range(n)), reverse=True))
        assert sum(n for _, n in fixed) + fewest_bins.cached(rest, capacity) == fewest_bins.cached(tuple(sorted(sizes, reverse=True)), capacity), sizes


def test_packing_reaches_the_lower_bound_in_many_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARE_PIECES", (3, 5))
    got = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), path("byte_bpe_50k.json")).collect()
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = [0, *(a + b for a, b in sorted(places))]
        assert [a for a, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048
    assert len(bins) == -(-sum(r["length"] for r in got) // 2048)


def test_packing_nothing(empty):
    assert packing.pack_documents(empty, path("byte_bpe_50k.json")).count() == 0


# --- edit fingerprints


def test_edit_fingerprints(spark, docs):
    got = edit_fingerprint.edited_digest(docs).collect()
    rows = sorted(((i, t or "") for i, t in rows_of(docs)), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    walk = edit_fingerprint.Walk()
    want = []
    for (i, t), (_, following) in zip(rows, [*rows[1:], rows[0]], strict=True):
        h = len(t) // 2
        edited = t[: len(t) - h] + following[:h]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), walk.fingerprint(t), walk.fingerprint(edited)))
    assert counted(tuple(r)[:5] for r in got) == counted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    long = [r for r in got if r["n_chars"] > 300]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.45 > 0.2 > sum(r["near_next"] for r in long) / len(long)


def test_walk_by_definition():
    """The automaton against the walk taken step by step."""
    walk = edit_fingerprint.Walk()
    text = "The quick brown fox jumps over the lazy dog. " * 60
    codes = walk.codes(text)
    entered, _, end = walk.run(codes)
    classes = ((codes * 2654435761) >> 26).astype("uint8")
    rows, at = walk.rows, 0
    for i, c in enumerate(classes):
        assert entered[i] == at
        after = rows[at % 4096][int(c)][-1]
        at += (after - at % 4096 - 1) % 4096 + 1
    assert end == at and 1.5 < end / len(text) < 2.6


def test_walk_survives_edits():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij klmnop") for _ in range(4000))
    walk = edit_fingerprint.Walk()
    own = walk.fingerprint(text)
    assert edit_fingerprint.likeness(own, walk.fingerprint(text[:500] + "XY" + text[500:])) > 0.8
    assert edit_fingerprint.likeness(own, own) == 1 and edit_fingerprint.likeness("", "") == 1


def test_near_copies_stay_alike_after_ten_insertions():
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    walk = edit_fingerprint.Walk()
    likes = []
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(350))
        edited = text
        for _ in range(10):
            at = rng.randrange(len(edited))
            edited = edited[:at] + rng.choice("etaoinshrdlu") + edited[at:]
        likes.append(edit_fingerprint.likeness(*walk.fingerprints([text, edited])))
    assert sum(x < 0.8 for x in likes) <= 6


def test_walks_side_by_side():
    rng = random.Random(6)
    walk = edit_fingerprint.Walk()
    texts = [None, "", "a", *("".join(rng.choice("abc é中") for _ in range(rng.choice([3, 70, 900, 9000]))) for _ in range(80)), "xy" * 200_000]
    assert walk.fingerprints(texts) == [walk.fingerprint(t or "") for t in texts]


def test_near_documents(spark):
    body = " ".join(f"word{k}x{k * 7 % 13}" for k in range(300))
    rows = [(1, body), (2, body), (3, body[:900] + "!" + body[900:]), (4, body[::-1]), (5, None), (6, "")]
    rows.append((7, body[:700] + "".join(reversed(body[700:900])) + body[900:]))
    got = edit_fingerprint.near_documents(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5), (6, 5), (7, 1)]
    assert len({r["fingerprint"] for r in got if r["class_id"] == 1}) > 1


def test_edit_fingerprints_tell_short_texts_apart():
    walk = edit_fingerprint.Walk()
    short = ["", "a", "b", "c", "ab", "ba", "abcd", "abce", "xyz", "abcdefgh", "abcdefgi", "a" * 5, "a" * 6]
    prints = walk.fingerprints(short)
    assert len(set(prints)) == len(short)
    assert max(edit_fingerprint.likeness(a, b) for k, a in enumerate(prints) for b in prints[:k]) < 1


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)", "double"])
def test_edited_texts_follow_ids_of_any_kind(spark, kind):
    rows = [(str(k * 7 % 101), f"text {k} " * (k % 5)) for k in range(101)] + [(None, "no id"), ("13", "again")]
    df = spark.createDataFrame(rows, "doc_id string, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    got = edit_fingerprint.edited_digest(df).collect()
    key = (lambda i: i) if kind == "string" else (lambda i: float(i) if i is not None else None)
    order = sorted(((key(i), t) for i, t in rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    want = []
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        h = len(t) // 2
        want.append((i, hashlib.sha256((t[: len(t) - h] + following[:h]).encode()).hexdigest()))
    assert counted((key(None if r["doc_id"] is None else str(r["doc_id"])), r["edited_sha256"]) for r in got) == counted(want)


def test_bands_find_near_fingerprints_and_few_others():
    rng = random.Random(21)
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.01/documents.parquet' where length(text) between 40 and 6000 order by doc_id limit 260").fetchall()]
    walk = edit_fingerprint.Walk()
    own = walk.fingerprints(texts)
    near = []
    for t, f in zip(texts, own, strict=True):
        for edits in (1, 3, 10):
            x = t
            for _ in range(edits):
                at = rng.randrange(len(x))
                x = x[:at] + rng.choice(["", "q", "z "]) + x[at + rng.randrange(2) :]
            near += [(f, g) for g in walk.fingerprints([x]) if f != g and edit_fingerprint.likeness(f, g) >= 0.8]
    met = sum(not edit_fingerprint.band_keys(a).isdisjoint(edit_fingerprint.band_keys(b)) for a, b in near)
    keys = [edit_fingerprint.band_keys(f) for f in own]
    far = [(i, j) for i in range(len(own)) for j in range(i) if edit_fingerprint.likeness(own[i], own[j]) < 0.5]
    others = sum(not keys[i].isdisjoint(keys[j]) for i, j in far)
    print("recall", met, len(near), "others", others, len(far))
    assert len(near) > 500 and met >= 0.98 * len(near) and others <= 0.002 * len(far), (met, len(near), others, len(far))


def test_near_documents_against_all_pairs(spark):
    rng = random.Random(22)
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet' where length(text) between 100 and 2500 order by doc_id limit 60").fetchall()]
    texts += [t[: len(t) // 3] + rng.choice("qz") + t[len(t) // 3 :] for t in texts[:30]] + texts[:10] + ["", "a", "b"]
    prints = edit_fingerprint.Walk().fingerprints(texts)
    roots = brute_components(prints, lambda a, b: a == b or edit_fingerprint.likeness(a, b) >= 0.8)
    low = {}
    for i, r in enumerate(roots):
        low.setdefault(r, i)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: r["class_id"] for r in edit_fingerprint.near_documents(df).collect()}
    assert got == {i: low[r] for i, r in enumerate(roots)}


def test_edit_fingerprints_nothing(empty):
    assert edit_fingerprint.near_documents(empty).count() == 0
    assert edit_fingerprint.edited_digest(empty).count() == 0


# --- HTML


def test_html_text(spark):
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <nav><ul><li><a href="/a">A</a></li></ul></nav><!-- c --><div class="ad">Buy now, a long advert with many many words in it.</div>
    <div class="cookie-notice">We use cookies</div><article><h1>Head&nbsp;line</h1><p><b>First &lt;para&gt;<br>goes
      on.<p>Second</p><form><p>name</p><input></form><p>Ti.</p><aside>related</aside><section class="comments"><p>reader says</p></section></article>
    <footer>&copy; x</footer></body></html>"""
    assert html_text.main_text(page) == "Head line\n\nFirst <para> goes on.\n\nSecond\n\nTi."
    for odd_page in ("", None, "<p", "plain words", "<div><p>a</div></p></p>", "<nav>only", "&#x41;&bogus;"):
        html_text.main_text(odd_page)
    assert html_text.main_text("plain words") == "plain words"
    divs = "<div id=nav>" + "<a>x</a> " * 20 + "</div><div id=main>" + "<p>words and more words of the real text here</p>" * 6 + "</div>"
    assert html_text.main_text(divs).count("real text") == 6 and "x x" not in html_text.main_text(divs)
    df = spark.createDataFrame([(1, "u", page, "z"), (2, None, None, "z")], "page_id int, url string, html string, text string")
    got = html_text.page_texts(df).collect()
    assert sorted(r["n_chars"] for r in got) == [0, len(html_text.main_text(page))]


def test_html_text_around_the_region():
    long = "<p>words and more words of the real text here</p>" * 12
    real = ["words and more words of the real text here"] * 12
    got = html_text.main_text(f"<body><div><h1>Title</h1><div class=body>{long}</div></div></body>")
    assert got.split("\n\n") == ["Title", *real]
    sections = f"<body><div><section>{long}</section><section><h2>Note</h2><p>short part, <a>linked</a></p><p><a>source</a></p></section></div></body>"
    assert html_text.main_text(sections).split("\n\n") == [*real, "Note", "short part, linked", "source"]
    articles = f"<body><article><p>brief</p></article><article>{long}</article></body>"
    assert html_text.main_text(articles).split("\n\n") == ["brief", *real]
    links = "<div><ul>" + "<li><a href=x>elsewhere</a></li>" * 5 + "</ul></div>"
    assert html_text.main_text(f"<body>{links}<h1><a>Title</a></h1><main>{long}<p><a>source</a></p></main>{links}</body>").split("\n\n") == ["Title", *real, "source"]


def plain_article(page):
    """The only article of a page by regular expressions: blocks between block tags, references decoded."""
    import html

    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|h2|ul|li|div)\b[^>]*>", inner)
    words = [html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split() for b in blocks]
    return "\n\n".join(" ".join(w) for w in words if w)


def test_html_text_against_plain_version(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = counted((r["page_id"], r["url"], plain_article(r["html"])) for r in pages.collect())
    got = html_text.page_texts(pages).collect()
    assert counted((r["page_id"], r["url"], r["text"]) for r in got) == want and all(r["n_chars"] == len(r["text"]) for r in got)


def test_html_text_of_made_pages():
    """Pages made of known blocks and furniture give back exactly the blocks."""
    rng = random.Random(11)
    word = lambda: rng.choice(["tide", "moon", "a &lt; b", "na&iuml;ve", "sand", "<b>salt</b>", "<i>sea</i>", "shore\n "])
    prose = lambda n: " ".join(word() for _ in range(n))
    plain = lambda x: " ".join(re.sub("<[^>]*>", "", x).replace("&lt;", "<").replace("&iuml;", "\u00ef").split())
    links = lambda: "".join(f"<li><a href=/{k}>{word()}</a>" for k in range(6))
    noise = ["<script>var a='<p>no</p>'</script>", "<!-- <p>no</p> -->", "<![endif]>", "<p hidden>no</p>", "<div style='display: none'>no</div>"]
    furniture = [
        lambda: f"<nav><ul>{links()}</ul></nav>", lambda: "<div class=cookie-notice><p>no " + prose(30) + "</div>", lambda: f"<form><p>{prose(9)}<input></form>",
        lambda: f"<div class='site-header'><a href=/>{word()}</a></div>", lambda: f"<aside><p>{prose(20)}</p></aside>", lambda: f"<div id=sidebar><p>{prose(12)}</div>",
        lambda: f"<section class=comments><p>{prose(25)}</p></section>", lambda: f"<div class='ad'>{prose(15)}</div>", lambda: f"<div class=related><h3>{word()}</h3><ul>{links()}</ul></div>",
    ]
    for _ in range(200):
        blocks = [prose(rng.randint(20, 60)) for _ in range(rng.randint(4, 9))]
        heading = prose(4)
        body = [f"<div class={rng.choice(['post-header', 'entry-header', 'x'])}><h1>{heading}</h1></div>"]
        for b in blocks:
            body += [f"<p>{b}" + rng.choice(["", "</p>"]), *rng.sample(noise, rng.randint(0, 2))]
            if rng.random() < 0.3:
                body.append(rng.choice(furniture)())
        outer = rng.choice(["article", "main", "div class=text", "div class='with-sidebar'"])
        page = "<head><title>no</title><body>" + "".join(f() for f in rng.sample(furniture, 3)) + f"<{outer}>" + "".join(body) + f"</{outer.split()[0]}>" + rng.choice(furniture)() + "<footer>no</footer>"
        assert html_text.main_text(page) == "\n\n".join(map(plain, [heading, *blocks])), page


def test_html_text_of_broken_markup():
    assert html_text.main_text("<p>a</p><![foo[x]]><p>b</p>") == "a\n\nb"
    assert html_text.main_text("<p>a<!x") == "a" and html_text.main_text("<!DOCTYPE html [<!ELEMENT p (a)>]><p>t</p>") == "t"
    assert html_text.main_text("<p>k <span hidden>no <span>x</span> no</span> yes</p><p hidden>h</p>") == "k yes"
    assert html_text.main_text("<head><title>t</title><p>body") == "body"
    long = "<p>words and more words of the real text here</p>" * 12
    closing = f"<div><h1>Title</h1><div>{long}</div><div><p>Closing paragraph of it all.</p></div></div>"
    assert html_text.main_text(closing).split("\n\n")[::13] == ["Title", "Closing paragraph of it all."]
    rng = random.Random(12)
    bits = ["<", ">", "</", "<!", "<![", "]>", "]]>", "<!--", "-->", "<?", "<p", "<p>", "</p>", "<div>", "</div>", "<a href=", '"', "'", "<td>", "<li>", "</li>", "<script>", "</script>", "<svg>", "<head>", "<body>"]
    bits += ["&", "&#", "&#x", ";", "&amp;", " ", "\n", "x", "words of text", "\x00", "<span hidden>", "</span>", "<article>", "</article>", "<header>", "<nav class=header>", "/>", "=", "<![CDATA[", "<!DOCTYPE"]
    for _ in range(4000):
        html_text.main_text("".join(rng.choices(bits, k=rng.randint(1, 25))))


@pytest.mark.parametrize(
    "page",
    ["<div>" * 40_000 + "x" + "</div>" * 40_000, "<div><p>t" * 40_000, "<div>" * 40_000 + "</section>" * 40_000 + "x", "<a " * 300_000, '<a href="' * 100_000, "<!--" * 100_000, "<td><th>" * 40_000, "<span hidden>" * 40_000, "<div class=header>" * 20_000 + "x", "<!" * 200_000],
)
def test_html_text_takes_time_in_proportion(page):
    import time

    began = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - began < 8


# --- all on nothing


def test_everything_on_nothing(empty):
    assert secret_scan.secret_digest(empty).count() == 0
    assert simhash.simhash_digest(empty).count() == 0
    assert html_text.page_texts(empty.selectExpr("doc_id page_id", "text url", "text html", "score")).count() == 0
    assert quality_rules.judge_quality(empty).count() == 0
    assert bpe.bpe_digest(empty, path("byte_bpe_multi_50k.tiktoken"), PATTERN).count() == 0
