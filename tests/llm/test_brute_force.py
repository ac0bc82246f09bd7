"""Each operator against a plain version of its contract, on documents with nulls, empty and long texts,
ties, repeated rows and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gaugeflow.llm import bitplanes, context_tree, exact_dedup, fingerprint, mixing, packing, pii, quality, shingle_join, url_filter
from gaugeflow.llm.components import components, stars
from gaugeflow.llm.radix import RadixTrie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, source string, kept string, pii string"


def _texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    texts = [None, "", " \t\n ", "one", "One two", "x" * 5000, "\u4e2d\u6587 words 'twas don't \u00a0 \u2028 end <|endoftext|>", "a@b.c_d@e.fg 1.2.3.4.5 999.1.1.1 +1 (436) 555-8670 4111 1111 1111 1111 12"]
    for _ in range(60):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 300))) + ".\nLast line " + str(rng.random()))
    long = " ".join(rng.choice(vocabulary) for _ in range(9000))
    texts += [long, long + " tail", texts[20], texts[20].replace(" ", "  "), texts[21].upper()]
    for base in (texts[25], texts[26]):  # chains of near copies
        words = base.split()
        for k in range(8):
            words[(17 * k) % len(words)] = f"new{k}"
            texts.append(" ".join(words))
    return texts


@pytest.fixture(scope="module")
def table():
    rows = [(3 * i, t, ["a", "b", None, "ß", "\U00010000"][i % 5] if i % 3 else "a", "x", "y") for i, t in enumerate(_texts())]
    return [*rows, rows[10], (None, "no key here", "b", None, None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame(table, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _found(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def _base_spans(text):
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and _luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in patterns.items() for m in re.finditer(p, text) if ok(m[0])]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def test_pii(spark, sf, docs, empty):
    hard = ["\u4e2d a@b.c\ud7ff 10.0.0.1, 256.1.1.1 007.0.0.255", "4111-1111-1111-1111 and 4111111111111112", "9" * 3000, "a" * 3000 + "@", "+12 (34) 567-89-01- +1 2", "IBAN DE89 3704 0044 0532 0130 00 ok, GB82WEST12345698765432 DE89370400440532013001", "my ssn is 123-45-6789; part 123-45-6789" + " " * 60, "call 436-555-8670", "see 436-555-8670 there", "x@y.z" * 50]
    own = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    for df in (own, docs.select("doc_id", "text"), spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")):
        for r in pii.find_pii(df).collect():
            got = [(s["kind"], s["start"], s["end"]) for s in r["pii"]]
            names = {k.name for k in pii.BASE}
            assert [s for s in got if s[0] in names] == _base_spans(r["text"] or "")
            assert all((r["text"] or "")[s["start"] : s["end"]] == s["value"] for s in r["pii"])
    kinds = {r["doc_id"]: Counter(s["kind"] for s in r["pii"]) for r in pii.find_pii(own).collect()}
    assert kinds[5]["iban"] == 2 and kinds[6]["ssn"] >= 1 and kinds[7]["local_phone"] == 1 and not kinds[8]["local_phone"]
    assert pii.find_pii(empty).count() == 0 and pii.find_pii(docs).count() == docs.count()


def test_pii_query(spark, sf):
    for r in pii.pii(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect():
        spans = _base_spans(r["text"] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_fingerprints(spark, docs, empty, table):
    got = fingerprint.compare_versions(docs)
    rows = got.collect()
    assert len(rows) == len(table)
    keys = sorted({r[0] for r in table if r[0] is not None})
    order = [None, *keys]
    text_of = {r[0]: r[1] or "" for r in table if r[0] is not None}
    text_of[None] = ""  # of the two null keys the smaller prefix stands
    prints = {}
    for r in rows:
        if r["doc_id"] is None:
            continue
        text, after = text_of[r["doc_id"]], text_of[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        cut = lambda t: set(re.findall(r"[^\n.!?]{1,96}[.!?]*|[.!?]+", t))
        a, b, c = cut(text), cut(edited), cut(after)
        alike = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert math.isclose(r["near_edited"], alike(a, b)) and math.isclose(r["near_next"], alike(a, c))
        assert len(r["only_own"]) == len(a - b) and len(r["only_edited"]) == len(b - a)
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert fingerprint.compare_versions(empty).count() == 0


def test_quality(spark, docs, empty):
    good = ["the plain words of a calm text number %d and so on" % i for i in range(300)]
    bad = ["THE!! LOUD!! WORDS!! %d!!" % i for i in range(300)]
    rows = [(i, t, int(t in set(good))) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    weights = quality.fit(df.where("doc_id % 2 = 0"))
    held = quality.score(df.where("doc_id % 2 = 1"), weights).collect()
    assert sum((r["score"] >= 0.5) == bool(r["label"]) for r in held) > 0.98 * len(held)
    assert np.array_equal(weights, quality.fit(df.where("doc_id % 2 = 0").repartition(7)))
    scored = quality.score(docs, weights)
    assert scored.columns == [*docs.columns, "score"] and all(0 <= r["score"] <= 1 for r in scored.collect())
    assert not quality.fit(df.limit(0)).any() and quality.score(empty, weights).count() == 0


def test_quality_query(spark, sf):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = quality.quality_classifier(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    pairs = [(g, b) for g, y in held if y == 1 for b, z in held if z == 0]
    assert sum(g > b for g, b in pairs) >= 0.9 * len(pairs)


def _components(texts, width=4, percent=85):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    up[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("leaf", [2, 192])
def test_shingle_join(spark, sf, docs, empty, table, leaf):
    got = shingle_join.near_duplicates(docs, leaf=leaf).collect()
    assert len(got) == len(table)
    assert {tuple(r) for r in got if r["doc_id"] is not None} == _components({r[0]: r[1] for r in table if r[0] is not None})
    real = spark.read.parquet(f"{sf}/documents.parquet")
    assert {tuple(r) for r in shingle_join.near_duplicates(real, leaf=leaf).collect()} == _components({r["doc_id"]: r["text"] for r in real.collect()})
    assert shingle_join.near_duplicates(empty).count() == 0


def test_components_hot_node_and_path(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path + star + [(5, 5)], "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1200)]}


@pytest.mark.parametrize("seed", range(20))
def test_stars_of_one_task(seed):
    random = np.random.default_rng(seed)
    n, ends = int(random.integers(1, 80)), random.integers(0, 60, (2, 80))
    u, v = ends[0][:n], ends[1][:n]
    forest = shingle_join.Forest(60)
    for a, b in zip(u, v):
        forest.unite(int(a), int(b))
    root, node = stars(u, v)
    assert dict(zip(node.tolist(), root.tolist())) == {int(k): forest.find(int(k)) for k in {*u, *v} if forest.find(int(k)) != k}


def test_url_rules(spark, sf):
    cases = {
        "http://A.Example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?x#y": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "x://a://org/": ("a:", "//org/", None, None),
        "http://a.com/fr/": ("a.com", "/fr/", "com/fr/", "allow"),
        "http://a.org": ("a.org", "", None, None),
        "http://a.org?/x": ("a.org", "", None, None),
        "no scheme": ("", "", None, None),
        None: ("", "", None, None),
    }
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(cases)], "page_id long, url string, host string")
    for r in url_filter.judge(df).collect():
        host, path, rule, verdict = cases[r["url"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0
    rows = url_filter.url_filters(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count() and {r["verdict"] for r in rows} <= {"allow", "block"}


def test_url_models_tell_ruled_hosts_apart(spark):
    rows = [(i, f"http://w{i}.good.org/calm/{i}") for i in range(300)] + [(1000 + i, f"http://w{i}.x.com/de/casino{i}") for i in range(300)]
    rows += [(2000 + i, f"http://z{i}.net/calm/{i}") for i in range(50)] + [(3000 + i, f"http://z{i}.net/de/casino{i}") for i in range(50)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert all(got[2000 + i] == "allow" and got[3000 + i] == "block" for i in range(50))


@pytest.mark.parametrize("held", [64, 24 << 20])
def test_exact_dedup(docs, empty, table, held):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in table:
        groups.setdefault(norm(r[1]), []).append(r[0])
    expected = Counter()
    for r in table:
        ids = groups[norm(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        expected[(r[0], keep, len(ids), r[0] == keep, hashlib.sha256(norm(r[1]).encode()).hexdigest())] += 1
    assert _found(exact_dedup.exact_duplicates(docs, held=held), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected
    left = exact_dedup.drop_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_radix_trie():
    rng = random.Random(2)
    rows = [(bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9))), rng.choice([None, *range(50)])) for _ in range(800)]
    trie = RadixTrie()
    for text, key in rows:
        trie.insert(text, key)
    stored = [(t, n.keep, n.count) for t, n in trie.terminals()]
    assert [t for t, *_ in stored] == sorted({t for t, _ in rows})
    for text, keep, count in stored:
        own = [k for t, k in rows if t == text]
        assert count == len(own) and keep == min((k for k in own if k is not None), default=None)
    assert sorted(t for t, _ in trie.spill()) == sorted({t for t, _ in rows}) and not list(trie.terminals())


def _ids(name, texts, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("unit,size", [("bit", 1000), ("byte", 1 << 16)])
def test_token_store(spark, docs, empty, table, tmp_path, unit, size):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    bitplanes.write_tokens(docs, str(tmp_path / "t"), path, 2, unit=unit, size=size)
    got = bitplanes.read_tokens(spark, str(tmp_path / "t")).collect()
    rows = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0))
    encoded = list(zip([r[0] for r in rows], _ids("byte_bpe_50k.json", [r[1] for r in rows], 2)))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((k, len(i), _crc(i)) for k, i in encoded)
    start, places = 0, {}
    for key, ids in encoded:
        places.setdefault(key, []).append(start)
        start += len(ids)
    assert all(r["start"] in places[r["doc_id"]] for r in got if r["doc_id"] is not None)
    bitplanes.write_tokens(empty, str(tmp_path / "e"), path, 2)
    assert bitplanes.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_planes_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.integers(0, 50257, 5001), np.array([0]), np.array([2**32 - 1, 0]), np.zeros(0, int)):
        for unit in ("bit", "byte"):
            assert np.array_equal(bitplanes.from_planes(bitplanes.to_planes(ids.astype(np.uint32), unit), len(ids), unit), ids)


def test_lm_scoring(docs, empty, table):
    texts = [(r[0], r[1] or "") for r in table]
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    counts = Counter()
    for k, t in texts:
        if not held(k):
            counts.update([*WORD.findall(t.translate(LOWER)), None])
    n, v = sum(counts.values()), len(counts)
    got = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r for r in context_tree.score_texts(docs, block=20_000).collect()}
    tree = _tree([t for k, t in texts if not held(k)])
    for k, t in texts:
        tokens = [*WORD.findall(t.translate(LOWER)), None]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        r = got[(k, len(tokens), round(base, 6))]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (held(k), sum(w in counts for w in tokens), n)
        if len(t) < 400:
            assert math.isclose(r["score"], _tree_score(tree, t), rel_tol=1e-4, abs_tol=1e-4)
    assert context_tree.score_texts(empty).count() == 0


def _steps(text):
    data = bytes(context_tree.DEPTH) + text.encode() + b"\0"
    for i in range(context_tree.DEPTH, len(data)):
        for step in range(8):
            yield data[i - context_tree.DEPTH : i][::-1], (step, data[i] >> (8 - step)), data[i] >> (7 - step) & 1


def _tree(texts):
    """(context, decision) -> [zeros, ones], and the log-probability of each subtree."""
    n, children = {}, {}
    for text in texts:
        for context, decision, bit in _steps(text):
            for d in range(context_tree.DEPTH + 1):
                node = (context[:d], decision)
                n.setdefault(node, [0, 0])[bit] += 1
                if d:
                    children.setdefault((context[: d - 1], decision), set()).add(node)
    logs = {}
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    for node in sorted(n, key=lambda x: -len(x[0])):
        own = kt(*n[node])
        below = sum(logs[c][0] for c in children.get(node, ()))
        whole = own if len(node[0]) == context_tree.DEPTH else np.logaddexp(own, below) - math.log(2)
        logs[node] = (whole, own, below)
    return n, logs


def _tree_score(tree, text):
    n, logs = tree
    total = 0.0
    for context, decision, bit in _steps(text):
        p = 0.5
        for d in range(context_tree.DEPTH, -1, -1):
            node = (context[:d], decision)
            if node in n:
                own = (n[node][bit] + 0.5) / (sum(n[node]) + 1)
                share = 1.0 if d == context_tree.DEPTH else 1 / (1 + math.exp(min(700, logs[node][2] - logs[node][1])))
                p = share * own + (1 - share) * p
            else:
                p = 0.5
        total += math.log10(p)
    return total


def test_mixing(spark, docs, empty, table, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = mixing.mix(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(docs).collect()))
    assert len(got) == len(table)
    sizes = Counter()
    for r in table:
        sizes[r[2]] += len(WORD.findall(r[1] or ""))
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        level = (total - sum(capped.values())) / sum(weight[s] for s in names if s not in capped)
        over = [s for s in names if s not in capped and level * weight[s] > 2 * sizes[s]]
        if not over:
            break
        capped |= {s: 2.0 * sizes[s] for s in over}
    target = {s: capped.get(s, level * weight[s]) for s in names}
    taken = Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], target[r["source"]]) and r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    longest = max(len(WORD.findall(r[1] or "")) for r in table)
    assert all(abs(taken[s] - target[s]) <= longest for s in names)
    assert mixing.mix(empty).count() == 0


def test_pivot_keeps_sums_and_expectations(spark):
    rng = np.random.default_rng(3)
    p, size = np.full(400, 0.3), rng.integers(1, 50, 400).astype(float)
    mean = np.zeros(400)
    for k in range(300):
        q = p.copy()
        left = mixing.pivot(q, size, np.random.default_rng(k))
        assert math.isclose(q @ size, p @ size) and sum((x != 0) & (x != 1) for x in q) <= 1 and (left is None or 0 < q[left] < 1)
        mean += q / 300
    assert abs(mean.mean() - 0.3) < 0.01
    rows = spark.range(3000).selectExpr("id as row", "if(id < 1500, 'hot', null) as source", "1 + id % 7 as size")
    wanted = mixing.targets(rows)
    by = {r["source"]: r["n"] for r in rows.join(mixing.copies(rows, wanted, group=50, fan_in=3), "row").selectExpr("source", "size * copies as n").groupBy("source").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert all(abs(by[r["source"]] - r["target"]) <= 7 for r in wanted.collect())


def test_packing(spark, docs, empty, table):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path, room=256).collect()
    expected = Counter()
    for key, ids in zip([r[0] for r in table], _ids("word_bpe_49k.json", [r[1] for r in table], 0)):
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            expected[(key, piece, start, len(part), _crc(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    _gapless(rows, 256)
    assert packing.pack(empty, path).count() == 0


def _gapless(rows, room):
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = np.random.default_rng(seed)
    room = [10, 50, 100, 2048, 7, 30][seed]
    lengths = rng.integers(1, room + 1, 400)
    histogram = Counter(int(x) for x in lengths)
    first, length, times, sequence, offset = packing.plan(histogram, room)
    rank = np.arange(len(lengths))
    k = np.searchsorted(first, rank, "right") - 1
    turn = np.divmod(rank - first[k], times[k])
    rows = [{"sequence_id": s, "offset": o, "length": n} for s, o, n in zip(sequence[k] + turn[0], offset[k] + turn[1] * length[k], np.sort(lengths))]
    assert np.array_equal(length[k], np.sort(lengths))
    bins = _gapless(rows, room)
    assert bins <= math.ceil(lengths.sum() / room) * 11 / 9 + 1


@pytest.mark.parametrize("seed", range(20))
def test_dominance_keeps_the_optimum(seed):
    rng = np.random.default_rng(seed)
    room = 12
    lengths = sorted((int(x) for x in rng.integers(2, room + 1, 9)), reverse=True)

    def best(items, bins=()):
        if not items:
            return len(bins)
        out = best(items[1:], (*bins, room - items[0]))
        for left in {b for b in bins if b >= items[0]}:
            k = bins.index(left)
            out = min(out, best(items[1:], (*bins[:k], left - items[0], *bins[k + 1 :])))
        return out

    counts = np.bincount(lengths, minlength=room + 1).astype(np.int64)
    fixed = packing.reduce_by_dominance(counts, room)
    rest = tuple(x for x in range(room, 0, -1) for _ in range(counts[x]))
    assert sum(n for n, _ in fixed) + best(rest) == best(tuple(lengths))


def test_patterns_do_not_grow_with_the_pieces():
    """Lengths of which two fit and never three: a few patterns for any number of pieces."""
    found = []
    for n in (1000, 1_000_000):
        counts = np.zeros(2049, np.int64)
        counts[1000:1020] = n // 20
        fixed = packing.reduce_by_dominance(counts, 2048)
        assert sum(times * sum(k for _, k in runs) for times, runs in fixed) + counts.sum() == n
        found.append(len(fixed))
    assert found[0] == found[1] <= 40
