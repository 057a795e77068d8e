"""Operators against brute force, and their edge cases: nulls, empty tables, ties, repeated rows, clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from limitrank.llm import ann, bpe, chat, embed_dedup, jaccard, langid, mixing, queries, url_filter, warc

WORDS = "ein the of und para les con was nicht pour every small"


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, data, name):
    got = queries.queries()[name](spark, data)
    cols = sorted(got.columns)
    con = duckdb.connect()
    for t in ("conversations", "documents", "pages"):
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    want = con.execute(f"select {', '.join(cols)} from ({queries.oracle_sql()[name]})").fetchall()
    assert want and sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want))


# 1
def test_chat_round_trip(spark, data):
    out = {r.conv_id: r for r in queries.chat_formatting(spark, data).collect()}
    rows = defaultdict(list)
    for r in spark.read.parquet(f"{data}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        rows[r.conv_id].append((r.role or "", r.text or ""))
    rows[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(out) == set(rows)
    for k, turns in rows.items():
        told, learned = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(t for r, t in turns if r == "assistant")
        assert (out[k].n_turns, out[k].loss_chars) == (len(turns), len(learned))
        assert out[k].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert out[k].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_folds_events(spark):
    e = spark.createDataFrame([
        (1, 0, "u", "message", "user", "hi"), (1, 1, "a", "message", "assistant", ""), (1, 2, "a", "delta", None, "he"), (1, 3, "a", "delta", None, "llo"),
        (1, 4, "u2", "message", "user", "more"), (1, 5, "a", "regenerate", None, None), (1, 6, "a", "delta", None, "again"), (1, 7, "u", "edit", None, "hey"),
        (1, 8, "x", "message", "user", "gone"), (1, 9, "x", "delete", None, None), (2, None, "n", None, None, None),
    ], "conv_id int, seq int, msg_id string, kind string, role string, text string").withColumn("turn", F.lit("clash"))
    for span, large in ((1, 0), (3, 0), (256, 0), (256, 1024), (3, 5)):
        got = chat.fold_events(e, span, large).orderBy("conv_id", "pos").collect()
        assert [(r.conv_id, r.role, r.text) for r in got] == [(1, "user", "hey"), (1, "assistant", "again"), (2, "", "")]
    assert chat.format_conversations(e.limit(0)).count() == 0


def fold_by_hand(events):
    """Final (role, text) of each conversation, event by event."""
    order = lambda e: tuple((x is not None, x if x is not None else 0) for x in (e["seq"],)) + (e["kind"], e["role"] or "", e["text"] or "")
    convs = defaultdict(lambda: defaultdict(list))
    for e in events:
        convs[e["conv_id"]][e["msg_id"]].append(e | {"kind": e["kind"] if e["kind"] in ("delta", "edit", "regenerate", "delete") else "message"})
    out = {}
    for conv, messages in convs.items():
        made = []
        for name, parts in messages.items():
            parts.sort(key=order)
            text, alive, role, regen = "", True, None, None
            for p in parts:
                if p["kind"] == "delta":
                    text += p["text"] or ""
                else:
                    text, alive = ("" if p["kind"] == "regenerate" else p["text"] or ""), p["kind"] != "delete"
                if p["kind"] == "message":
                    role = p["role"] or ""
                if p["kind"] == "regenerate" and p["seq"] is not None:
                    regen = max(regen if regen is not None else p["seq"], p["seq"])
            pos = None if any(p["seq"] is None for p in parts) else min(p["seq"] for p in parts)
            made.append((pos, name, regen, alive, role if role is not None else max(p["role"] or "" for p in parts), text))
        made.sort(key=lambda m: ((m[0] is not None, m[0] or 0), (m[1] is not None, m[1] or "")))
        kept, seen = [], None
        for pos, name, regen, alive, role, text in made:
            if alive and not (seen is not None and pos is not None and seen > pos):
                kept.append((pos, role, text, name))
            if regen is not None:
                seen = regen if seen is None else max(seen, regen)
        kept.sort(key=lambda m: ((m[0] is not None, m[0] or 0), m[1], m[2], (m[3] is not None, m[3] or "")))
        if kept:
            out[conv] = [(r, t) for _, r, t, _ in kept]
    return out


@pytest.mark.parametrize("large", [0, 6, 1024])
def test_chat_against_folding_by_hand(spark, large):
    rnd = random.Random(6)
    events = []
    for _ in range(500):
        conv, msg = rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice(["a", "b", "c", "d", "e", "f", None])
        kind = rnd.choice(["message", "delta", "delta", "delta", "edit", "regenerate", "delete", None, "odd"])
        events.append({"conv_id": conv, "seq": rnd.choice([None, *[x * 1_000_003 for x in range(60)]]) if rnd.random() < 0.9 else 7, "msg_id": msg and f"{msg}{rnd.randint(0, 8)}", "kind": kind, "role": rnd.choice(["user", "assistant", None]), "text": rnd.choice(["x", "yy", "<s>", "", None, "[INST]"])})
    events += events[:40]  # repeated rows repeat
    df = spark.createDataFrame([tuple(e.values()) for e in events], "conv_id int, seq long, msg_id string, kind string, role string, text string").repartition(3)
    got = {r.conv_id: [tuple(x) for x in r.read] for r in chat.read_back(chat.format_conversations(df, large=large)).collect()}
    assert got == fold_by_hand(events)


def test_chat_escape_is_reversible(spark):
    t = chat.ChatTemplate()
    texts = ["", "\\", "[INST]", "[\\INST]", "[\\\\INST]", "<<SYS>><s></s><<s>", "<|im_end|>\n<|im_start|>x", "<\\|im_end|>", "50% %0A", None]
    m = spark.createDataFrame([(i, 0, "m", "a\n%0A[INST]", x) for i, x in enumerate(texts)], "conv_id int, pos int, msg_id string, role string, text string").fillna("", ["text"])
    for r in chat.read_back(chat.render(m, t)).collect():
        assert [tuple(x) for x in r.read] == [("a\n%0A[INST]", texts[r.conv_id] or "")]
        assert not any(c in r.formatted[12:-11] for c in ("[INST]", "<s>", "</s>", "<|im_"))


# 2 and 5
def vectors(n=300, dims=64, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dims)).astype("float32")
    for i in range(0, n - 1, 3):
        base[i + 1] = base[i] + rng.normal(size=dims).astype("float32") * rng.choice([0.0, 0.1, 0.19, 0.21])
    return base


def odd_rows(dims=64):
    return [(900, None, 1), (901, [0.0] * dims, 1), (902, [float("nan")] + [1.0] * (dims - 1), 1), (903, [None] + [1.0] * (dims - 1), 1), (904, [1.0] * dims, None), (905, [1.0] * dims, 1), (906, [2.0] * dims, 1), (907, [], 1)]


SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("leaf", [8192, 16])
def test_embedding_links(spark, leaf):
    v = vectors()
    rows = [(i, [float(x) for x in v[i]], i % 2 if i % 3 else (i + 1) % 2) for i in range(len(v))] + odd_rows()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")), leaf_rows=leaf).collect()}
    ok = {i: (np.array(e, dtype=float), lab) for i, e, lab in rows if e and lab is not None and None not in e and np.isfinite(e).all() and any(e)}
    pairs = [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and ok[a][0] @ ok[b][0] / np.linalg.norm(ok[a][0]) / np.linalg.norm(ok[b][0]) >= 0.98]
    links, comp = Counter(x for p in pairs for x in p), union(pairs, [r[0] for r in rows])
    assert pairs and got == {i: (links[i], c, i == c) for i, c in comp.items()}


def test_embedding_tiles(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "TILE", 20)
    monkeypatch.setattr(embed_dedup, "HELD", 30)
    v = vectors(120, seed=2)
    rows = [(i, [float(x) for x in v[i // 2]], 0) for i in range(120)]
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert got == {i: int(n) - 1 for i, n in enumerate((u @ u.T >= 0.98).sum(axis=1))}
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    few = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), leaf_rows=8)
    assert {r.vec_id: r.n_links for r in few.collect()} == got


def test_vectors_of_other_lengths(spark):
    """Any one length is taken; several are an error and not silently left out."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=128)
    rows = [(i, [float(x) for x in v * (i + 1)], 0) for i in range(40)]
    assert {r.n_links for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()} == {39}
    assert ann.search(spark.createDataFrame(rows, SCHEMA)).count() == 40
    odd = spark.createDataFrame([*rows, (99, [1.0, 2.0], 0)], SCHEMA)
    for f in (embed_dedup.near_duplicates, ann.search):
        with pytest.raises(ValueError, match="one length"):
            f(odd)


def test_repeated_and_null_ids_of_vectors(spark):
    a, b, c = [1.0] * 8, [1.0] * 7 + [1.1], [-1.0] + [1.0] * 7
    rows = [(1, a, 0), (1, a, 0), (2, b, 0), (2, c, 0), (None, a, 0), (3, a, 1), (4, a, None)]
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    # a repeated row is one vector; both rows of id 1 link with that of id 2 which is near
    assert got == Counter({(1, 1, 1): 2, (2, 1, 1): 2, (2, 0, 1): 2, (3, 0, 3): 1, (4, 0, 4): 1})


def recall_of(spark, rows, **how):
    x = {i: np.array(e) for i, e, _ in rows}
    got = defaultdict(set)
    for r in ann.search(spark.createDataFrame(rows, SCHEMA), **how).collect():
        got[r.query_id].add(r.vec_id)
    every = np.array(sorted(x))
    m = np.stack([x[i] for i in every])
    hits = []
    for q in (i for i in every if i % 20 == 0):
        s = m @ x[q]
        want = [int(i) for i in every[np.lexsort((every, -s))] if i != q][:20]
        hits.append(len(got[q] & set(want)) / 20)
    return float(np.mean(hits))


def test_index_prunes_and_recalls(spark):
    """Clustered vectors: a walk over a small share of the entries finds the neighbours."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = (centres[rng.integers(60, size=6000)] + rng.normal(size=(6000, 16)) * 0.03).astype("float32")
    rows = [(i, [float(y) for y in v], 0) for i, v in enumerate(x)]
    assert recall_of(spark, rows) >= 0.9
    assert recall_of(spark, rows, portion=0.08) >= 0.9


def test_copies_use_up_no_walk(spark):
    """A third of the rows are one vector: recall of the others and exact ties by id."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1600, 16)).astype("float32")
    rows = [(i, [float(y) for y in (x[0] if i % 3 == 0 else x[i])], 0) for i in range(1600)]
    assert recall_of(spark, rows) >= 0.9
    one = ann.search(spark.createDataFrame([(0, [1.0, 0.5], 0)] * 30_000, SCHEMA))
    assert one.count() == 0


def test_nearest_neighbours(spark, data):
    t = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, dtype=float) for r in t.collect()}
    got = defaultdict(list)
    for r in ann.search(t).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q in (i for i in rows if i % 20 == 0):
        want = sorted(((-(rows[q] * x).sum(), i) for i, x in rows.items() if i != q))[:20]
        assert len(got[q]) == 20 and all(abs(s - (rows[q] * rows[i]).sum()) < 1e-12 for i, s in got[q])
        assert got[q] == sorted(got[q], key=lambda x: (-x[1], x[0]))
        hits += len({i for _, i in want} & {i for i, _ in got[q]}) / 20
    assert hits / len(got) >= 0.9


def test_nearest_edge_cases(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [0.0, 1.0], 0), (4, None, 0), (5, [0.0, 0.0], 0), (40, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0)]
    got = ann.search(spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit("clash")), centroids=4).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0)]
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0


# 3
def sets_of(text, words):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def check_jaccard(spark, rows, words, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)), words, percent).collect()}
    s = {i: sets_of(t, words) for i, t in rows}
    pairs = [(a, b) for a in s for b in s if a < b and s[a] and 100 * len(s[a] & s[b]) >= percent * len(s[a] | s[b])]
    comp = union(pairs, s)
    assert got == {i: (len(s[i]), comp[i]) for i in s}
    return pairs


@pytest.mark.parametrize(("words", "percent", "tile"), [(4, 85, 1024), (5, 80, 1024), (3, 70, 7)])
def test_jaccard_join(spark, monkeypatch, words, percent, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "SLAB", 3 if tile < 100 else 4096)
    monkeypatch.setattr(jaccard, "FREQUENT_PART", 20 if words == 5 else 2000)
    rnd = random.Random(words)
    base = [[rnd.choice(WORDS.split()) + str(rnd.randint(0, 40)) for _ in range(rnd.randint(1, 90))] for _ in range(12)]
    rows = []
    for i in range(160):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 5)}" if rnd.random() < 0.7 else "The"
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(w)))
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "ONE"), (505, "é" * 70), (506, "é" * 69 + "e"), (507, "a\x00b c d e f"), (508, " ".join(map(str, range(3000)))), (509, " ".join(map(str, range(1, 3001))))]
    assert check_jaccard(spark, rows, words, percent)


def test_jaccard_rows_of_one_id(spark):
    """A repeated id is one document with the links of all its rows; a null id is left out."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(3, a), (3, b), (1, a + " end"), (2, b), (2, b), (None, a), (5, c), (6, c), (6, None)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").withColumn("gram", F.lit("clash")), 4, 85).collect())
    assert got == Counter({(3, 27, 1): 2, (1, 28, 1): 1, (2, 27, 1): 2, (5, 27, 5): 1, (6, 27, 5): 1, (6, 0, 5): 1})


def test_jaccard_empty(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert check_jaccard(spark, [(1, None), (2, None)], 4, 85) == []


# 4
def test_revisits(spark):
    t = lambda s: f"2024-01-0{s} 00:00:00"
    rows = [
        (1, "http://www.A.org/x#f", t(1), "response", "ETag: \"a\"\r\nContent-Type: text/html\r\nCache-Control: old", "d1"),
        (2, "https://a.org/x", t(3), "revisit", "etag: W/\"a\"\r\nCache-Control: new\r\nContent-Type: no", None),
        (3, "https://a.org/x", t(4), "response", "ETag: \"b\"", "d2"),
        (4, "https://a.org/x", t(4), "revisit", "ETag: \"a\"", None), (5, "https://a.org/x", t(6), "revisit", "ETag: \"a\"", None),
        (6, "https://a.org/x", t(6), "revisit", "", None), (7, "https://a.org/y", t(6), "revisit", "ETag: \"a\"", None), (8, None, t(6), "revisit", None, "d2"), (9, "https://a.org/x", t(6), "revisit", None, "d2"),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, ts string, type string, headers string, digest string").withColumn("ts", F.to_timestamp("ts")).withColumn("near", F.lit(1))
    got = {r.record_id: (r.status, r.original_id) for r in warc.resolve_revisits(df).collect()}
    assert got == {2: ("resolved", 1), 4: ("resolved", 1), 5: ("mismatch", None), 6: ("unverified", None), 7: ("missing", None), 8: ("missing", None), 9: ("resolved", 3)}
    merged = warc.resolve_revisits(df).where("record_id = 2").first().headers
    assert merged == {"etag": 'W/"a"', "content-type": "text/html", "cache-control": "new"}
    assert warc.resolve_revisits(df.limit(0)).count() == 0


@pytest.mark.parametrize("span", [1, 100, 10**9])
def test_revisits_against_brute_force(spark, span):
    """Ties, repeated rows, nulls and answers that are not full, on a url that is captured very often."""
    rnd = random.Random(span)
    rows = []
    for i in range(400):
        url = rnd.choice(["http://a.org/x", "HTTPS://www.A.org:443/x#f", "http://a.org/x", "http://b.org", "http://b.org/", None])
        rows.append((rnd.choice([i, i, 7]), url, rnd.choice([None, *range(1, 300)]), rnd.choice(["response", "revisit", "revisit", "request"]), rnd.choice([None, "", "ETag: a", "etag: W/b", "ETAG: c\nno colon\n: x\netag: a"]), rnd.choice([None, "d", "e"]), rnd.choice([None, 200, 200, 404, 206])))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "record_id long, url string, at long, type string, headers string, digest string, http_status int").withColumn("ts", F.timestamp_seconds("at")).withColumn("near", F.lit(1)).repartition(3)
    got = Counter((r.record_id, r.status, r.original_id) for r in warc.resolve_revisits(df, span).collect())
    name = {None: None, "http://b.org": "b", "http://b.org/": "b"}
    tag = lambda h: {None: None, "": None, "ETag: a": "a", "etag: W/b": "b"}.get(h, "a")
    want = Counter()
    for rid, url, at, kind, h, d, _ in rows:
        if kind != "revisit":
            continue
        key = name.get(url, "a")
        before = [(t, r, x, y) for r, u, t, k, x, y, s in rows if k == "response" and s in (None, 200) and t is not None and at is not None and t < at and key is not None and name.get(u, "a") == key]
        if not before:
            want[rid, "missing", None] += 1
            continue
        last = max(b[:2] for b in before)
        options = set()
        for _, r, x, y in (b for b in before if b[:2] == last):
            told = [p == q for p, q in ((tag(h), tag(x)), (d, y)) if p is not None and q is not None]
            options.add((rid, "unverified" if not told else "resolved" if all(told) else "mismatch", r if told and all(told) else None))
        # rows that agree in url, time and id may differ otherwise; any of them may serve
        want[next((o for o in sorted(options, key=str) if got[o] > want[o]), sorted(options, key=str)[0])] += 1
    assert got == want


# 6
def test_mixing(spark, data):
    rows = queries.mixture(spark, data).collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    taken, target, most = Counter(), {}, Counter()
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = (r.target, r.source_size)
        most[source[r.doc_id]] = max(most[source[r.doc_id]], r["size"])
        assert r.taken in (0, r["size"], 2 * r["size"])
    total = sum(s for _, s in target.values())
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(target))}
    level = min((target[s][0] / weights[s] for s in target if target[s][0] < 2 * target[s][1] * 0.999999), default=None)
    for s, (t, n) in target.items():
        assert t == pytest.approx(min(2 * n, level * weights[s])) and abs(taken[s] - t) <= most[s] / 2 + 1
    assert sum(t for t, _ in target.values()) == pytest.approx(1.5 * total)


def test_mixing_edge_cases(spark):
    rows = [(1, "a b", "s"), (1, "a b", "s"), (2, None, "s"), (None, "c d e", None), (3, "", "empty")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("hash", F.lit("clash"))
    got = mixing.mix(d)
    assert got.count() == 5 and got.agg(F.sum("taken")).first()[0] <= 14
    assert mixing.mixed_documents(d).columns == d.columns
    assert mixing.mix(d.limit(0)).count() == 0


def test_source_targets_of_many_sources(spark):
    rng = random.Random(6)
    sizes = {f"host{rng.random():.6f}": rng.choice([0, 1, 5, rng.randrange(1, 10**6)]) for _ in range(500)} | {None: 70}
    deal = {k: (5, 2, 1)[i % 3] for i, k in enumerate(sorted(sizes, key=lambda k: (k is None, k or "")))}
    want, free, left = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:  # share what is left; whoever is above its limit stops there
        level = left / sum(deal[k] for k in free)
        over = {k for k in free if 2 * sizes[k] < level * deal[k]}
        if not over:
            want |= {k: level * deal[k] for k in free}
            break
        want |= {k: 2.0 * sizes[k] for k in over}
        left -= sum(2 * sizes[k] for k in over)
        free -= over
    d = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7)
    got = {r.source: r.target for r in mixing.source_targets(d, (5, 2, 1), 1.5, 2.0).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


# 7
def test_bpe_matches_library(spark, data):
    import public_tokenizers
    import tokenizers

    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    codec = bpe.Codec(open(public_tokenizers.path("byte_bpe_50k.json"), "rb").read())
    rnd = random.Random(5)
    texts = ["", "<|endoftext|>", "a<|endoftext|> b", "a" * 3000, " " * 500, "\u0558 \U0001f600\u00a0x\u2028 y"]
    texts += ["".join(rnd.choice("aaabbc  eetthn'sll ÈéüΩ漢字 \t\n0123.!-=") for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        ids = tok.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == ids
        assert codec.decode(codec.encode(t)) == tok.decode(ids, skip_special_tokens=False)
    rows = {r.doc_id: r for r in queries.tokens(spark, data).collect()}
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    for d in docs:
        ids = tok.encode(d.text or "", add_special_tokens=False).ids
        assert rows[d.doc_id].n_tokens == len(ids) and rows[d.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_bpe_table_is_deterministic(spark, monkeypatch):
    """At most one token ends in a byte state, also when the table starts anew; words of any bytes."""
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, codec = tokenizers.Tokenizer.from_file(path), bpe.Codec(open(path, "rb").read())
    rnd, auto = random.Random(9), codec.automaton
    words = ["".join(rnd.choice("etaoin shrdlu" * 3 + "'éßж漢😀0_-") for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    for limit in (1 << 17, 50):
        monkeypatch.setattr(bpe, "STATES", limit)
        for w in words:
            for piece in codec.split(w):
                assert auto.encode_word(piece.encode()) == tok.encode(piece, add_special_tokens=False).ids
    table = auto.table
    for state, row in list(enumerate(table.rows))[:500]:
        for byte in row:
            ends = set()
            for pair in table.open[state]:
                before, at = divmod(pair, len(table.tree))
                t = table.ending[table.tree[at][byte]] if byte in table.tree[at] else -1
                if t >= 0 and (before < 0 or auto.arc(before, t)):
                    ends.add(t)
            assert len(ends) <= 1


def test_bpe_rows(spark):
    """Null, empty, repeated and very long texts; clashing and extra columns; no rows."""
    import public_tokenizers
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = tokenizers.Tokenizer.from_file(path)
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "\x00 <|endoftext|>"), (4, "word " * 60_000), (5, "x" * 5000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "decoded": F.lit(7), "more": F.lit(1)})
    out = bpe.decode(bpe.encode(d, path), path)
    assert set(out.columns) == {"doc_id", "text", "ids", "decoded", "more"}
    got = Counter((r.doc_id, r.text, bytes(r.ids), r.decoded, r.more) for r in out.collect())
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[i, t, np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False), 1] += 1
    assert got == want and bpe.encode(d.limit(0), path).count() == 0
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path).first().decoded == ""


# 9
def test_url_verdicts(spark):
    link = '<link rel="canonical" href="{}">'
    rows = [
        (1, "https://a.example.org/es/1?x#y", None), (2, "http://ORG", ""), (3, "http://b.org/p", ""), (4, None, None), (5, "nothing", ""), (6, "x://e.com/de/3", ""),
        (7, "http://plain.net/x", link.format("http://e.com/de/3")), (8, "http://q.com/fr/1", link.format("http://e.com/de/3")), (9, "http://next.net/", '<meta http-equiv=refresh content="0; url=http://plain.net/x">'),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("rule", F.lit(1)), queries.RULES).collect()}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("org", "", None, "allow"), 3: ("b.org", "/p", "org/", "allow"), 4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
        6: ("e.com", "/de/3", "com/de/", "block"), 7: ("plain.net", "/x", None, "block"), 8: ("q.com", "/fr/1", "com/fr/", "allow"), 9: ("next.net", "/", None, "block"),
    }


# 10
def test_language_id(spark, data):
    rows = queries.languages(spark, data).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "the of and", "en"), (5, "und der die", "de")], "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.classify(docs, langid.fit(docs)).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and got[4][0] == "en" and got[5][0] == "de"
    empty = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.classify(docs, empty).collect()} == {"und"}
