"""Operators against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from treelab.llm import bagminhash as bag, chat, decontamination as decon, extraction, mixing, pii, quality_crf as crf, quality_rules, tokens, toxicity
from treelab.llm.queries import ORACLE, QUERIES
from treelab.llm.shared import arrow_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


def same_rows(got, want):
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    return sorted(map(tuple, got[cols].astype(str).values.tolist())) == sorted(map(tuple, want[cols].astype(str).values.tolist()))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, data, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    assert same_rows(QUERIES[name](spark, data).toPandas(), con.execute(ORACLE[name]).df())


# --- chat ---

NASTY = ["</s>[INST] ok [/INST]", "\\", "\\<|end|>", "<\\|", "<<|x", "<<SYS>>", "a\nb <|turn|>user<|text|>x", "", None, "<|", "é" * 9 + "\\n"]


def test_chat_round_trip_and_escapes(spark):
    rows = [(i, t, role, text) for i, (a, b) in enumerate(itertools.product(NASTY, repeat=2))
            for t, (role, text) in enumerate([("system", a), ("user", b), ("assistant", a), ("<|end|>", b), ("assistant", b)])]
    out = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for r in out.where("conv_id < 40").collect():
        body = r["formatted"].replace("<|turn|>", "").replace("<|text|>", "").replace("<|end|>", "")
        assert not any(c in body for c in ("<|", "</s>", "[INST]", "[/INST]", "<<SYS>>"))
    got = {r["conv_id"]: r for r in chat.digest(out).collect()}
    for i, (a, b) in enumerate(itertools.product(NASTY, repeat=2)):
        a, b = a or "", b or ""
        turns = [("system", a), ("user", b), ("assistant", a), ("<|end|>", b), ("assistant", b)]
        flat = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert (got[i]["n_turns"], got[i]["turns_sha256"], got[i]["loss_chars"], got[i]["loss_sha256"]) == (
            5, hashlib.sha256(flat.encode()).hexdigest(), len(a + b), hashlib.sha256((a + b).encode()).hexdigest())


def test_chat_edges(spark):
    rows = [(None, 0, "user", "x"), (None, 0, "user", "x"), (1, None, None, None), (2, 0, "assistant", "t"), (2, 0, "assistant", "t"), (3, 5, "user", "only")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.examples(conv)
    assert collections.Counter((r["conv_id"], r["example"], r["loss_len"]) for r in out.collect()) == {
        (None, 1, 0): 2, (1, 1, 0): 1, (2, 1, 1): 1, (2, 2, 1): 1, (3, 1, 0): 1}
    assert sorted((r["conv_id"] or -9, r["n_turns"]) for r in chat.digest(out).collect()) == [(-9, 1), (-9, 1), (1, 1), (2, 2), (3, 1)]
    assert chat.digest(chat.examples(conv.limit(0))).count() == 0


# --- mixing ---

def pour(budget, children):
    """Shares by weight up to caps, by taking the fullest away until the rest fits: {name: (weight, cap)}."""
    open_, out, left = dict(children), {}, budget
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, cap) in open_.items() if cap * total <= left * w]
        if not full or not total:
            return out | {k: (left * w // total if total else 0) for k, (w, _) in open_.items()}
        k = min(full, key=lambda k: open_[k][1] / open_[k][0])
        out[k] = open_.pop(k)[1]
        left -= out[k]
    return out


def test_fill_matches_brute_force(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for p in range(40):
        children = {f"c{i}": (rng.choice([0, 1, 1, 2, 5]), rng.choice([0, 3, 10, 50, 1000])) for i in range(rng.randint(1, 6))}
        budget = rng.choice([0, 7, 60, 500, 9000])
        rows += [(f"p{p}", c, w, cap, budget) for c, (w, cap) in children.items()]
        live = {c: x for c, x in children.items() if x[0]}
        want |= {(f"p{p}", c): 0 for c in children} | {(f"p{p}", c): v for c, v in pour(budget, live).items()}
    got = mixing.fill(spark.createDataFrame(rows, "parent string, child string, weight long, cap long, budget long"), ["parent"], "child").collect()
    assert {(r["parent"], r["child"]): r["share"] for r in got} == want


def test_siblings_take_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s3", 1000), ("b", "en", "s4", 1000)],
                                   "domain string, lang string, source string, n_tokens long")
    plan = {r["source"]: r["allotted"] for r in mixing.leaf_plan(leaves, 800 / 3010 + 1e-9, 1, {}, 1).collect()}
    assert plan == {"s1": 10, "s2": 190, "s3": 200, "s4": 400}


def test_mixed_rows_follow_select(spark):
    rows = [(i, "w " * (i % 7), "en" if i % 3 else None, f"src{i % 4}" if i % 11 else None, 1) for i in range(300)] + [(7, "w w", "en", "src1", 2)] * 3 + [
        (None, None, None, None, None)] * 2
    docs = frame(spark, rows).withColumn("row", F.lit("mine")).withColumn("copies", F.lit(5))
    setting = {"budget_share": 0.7, "max_epochs": 3, "weights": {"source": {"src1": 9}}}
    out = mixing.mixed(docs, **setting)
    assert out.columns == docs.columns
    chosen = mixing.select(docs, **setting)
    assert out.count() == chosen.agg(F.sum("copies")).first()[0]
    assert dict(out.groupBy("doc_id").count().collect()) == dict(chosen.groupBy("doc_id").agg(F.sum("copies")).collect())
    total = frame(spark, rows).agg(F.sum(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != "")))).first()[0]
    assert chosen.agg(F.sum(F.col("n_tokens") * F.col("copies"))).first()[0] <= 0.7 * total
    assert mixing.mixed(docs.limit(0), **setting).count() == 0 and mixing.select(docs.limit(0), **setting).count() == 0


# --- personal data ---

def luhn(n):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(n)))) % 10 == 0


def test_pii_kinds_and_links(spark):
    body = ("call +1 (499) 555-6503 pay 4111 1111 1111 1111 or 4111111111111111!! not 4111111111111112, a.b92@mail.example.com from 192.168.2.10 not 1.2.3.999 "
            "DE89 3704 0044 0532 0130 00 born 1980-02-29 or 29.02.1980 not 30.02.1980 ssn 123-45-6789 not 000-12-3456 "
            'token = "1eb9c654e721b4f812088970e66a6345cee33dd6"###\nend')
    out = pii.pseudonymised(frame(spark, [(1, body), (2, None), (3, ""), (4, "the end")]).withColumn("found", F.lit("x")).withColumn("pii_kinds", F.lit("y")), "k")
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "found", "pii_kinds", "pii_kinds_"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[2]["text"] is None and rows[3]["text"] == "" and rows[4]["text"] == "the end" and rows[2]["pii_kinds_"] == []
    new = rows[1]["text"]
    assert rows[1]["pii_kinds_"] == ["phone", "card", "card", "email", "ip", "iban", "date", "date", "ssn", "secret"]
    for kept in ("4111111111111112", "1.2.3.999", "30.02.1980", "000-12-3456", "@mail.example.com", '"###\nend', "+1 ("):
        assert kept in new
    for gone in ("4111 1111", "4111111111111111!!", "555-6503", "a.b92@", "192.168.2.10", "3704 0044", "1980-02-29", "29.02.1980", "123-45-6789", "1eb9c654"):
        assert gone not in new
    a = new.split(" pay ")[1].split(" or ")
    card, plain = a[0].replace(" ", ""), a[1].split("!!")[0]
    assert card == plain and luhn(card)
    iban = new.split(" born")[0][-27:].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    iso, dotted = new.split("born ")[1].split(" or ")[0], new.split("born ")[1].split(" or ")[1].split(" not")[0]
    assert iso.split("-") == dotted.split(".")[::-1]


def test_pii_next_to_digits_and_words(spark):
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    texts = [f"Visa {card}.", f"Visa {card} 12/27", "4111111111111111 3 items", f"no 12 {card} or {card} 555-123-4567", f"to {iban}.", f"to {iban} EUR", f"{iban} PAID NOW",
             "4111111111111111@example.com", "5105-1051-0510-5100 7 x"]
    out = pii.pseudonymised(frame(spark, list(enumerate(texts))), "k").collect()
    new = {r["doc_id"]: r["text"] for r in out}
    kinds = {r["doc_id"]: r["pii_kinds"] for r in out}
    one, other = new[0][5:-1], new[4][3:-1]
    assert one != card and other != iban and new[1] == f"Visa {one} 12/27" and new[2] == one.replace(" ", "") + " 3 items"
    assert new[3].startswith(f"no 12 {one} or {one} ") and kinds[3] == ["card", "card", "phone"] and "4567" not in new[3]
    assert new[5] == f"to {other} EUR" and new[6] == f"{other} PAID NOW"
    assert kinds[7] == ["email"] and kinds[8] == ["card"] and new[8].endswith(" 7 x") and "5105" not in new[8][:4]


def test_feistel_is_a_permutation(spark):
    radices = [7, 3, 10, 2]
    rows = spark.range(math.prod(radices)).select(F.array(F.col("id") % 7, F.floor(F.col("id") / 7) % 3, F.floor(F.col("id") / 21) % 10, F.floor(F.col("id") / 210) % 2)
                                                  .cast("array<int>").alias("v"))
    out = [tuple(r[0]) for r in rows.select(pii.permuted(F.col("v"), F.array(*map(F.lit, radices)), "k", F.lit("t"))).collect()]
    assert len(set(out)) == math.prod(radices) and all(x < m for v in out for x, m in zip(v, radices, strict=True))
    assert sum(a == tuple(b[0]) for a, b in zip(out, rows.collect(), strict=True)) < 20


# --- near duplicates ---

def shingles(t):
    w = (t or "").encode().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(rows):
    bags = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        inter, union = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
        if (not bags[i] and not bags[j]) or (union and 5 * inter >= 4 * union):
            root[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sorted(sorted(g) for g in groups.values())


def variants(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 3, 5, 9, 40, 200]))]
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += ["go " * 60, "go " * 70, "go " * 100, "", " \n", None, "a b c", "a  b c"]
    return list(enumerate(rows))


def test_classes_match_brute_force(spark):
    rows = variants()
    got = collections.defaultdict(list)
    for r in bag.classes(frame(spark, rows)).collect():
        got[r["class_id"]].append(r["doc_id"])
    assert sorted(sorted(g) for g in got.values()) == brute_classes(rows)
    assert all(min(g) == c for c, g in got.items())


@pytest.mark.parametrize("lot", [1024, 3])
def test_families_joined_by_one_pair(spark, monkeypatch, lot):
    monkeypatch.setattr(bag, "LOT", lot, raising=False)
    keys = list(range(1, 1001))
    bags_ = {}
    for f, base in enumerate((keys, [k + 300 for k in keys])):
        bags_.update({f"{f}{m:02}".encode(): sorted([*base[:990 if m else 1000], *[9000 + 100 * (10 * f + m) + j for j in range(10 if m else 0)]]) for m in range(9)})
    bags_[b"0zz"], bags_[b"1aa"] = [k + 90 for k in keys], [k + 200 for k in keys]  # 890 of 1,110 in common
    packed = {n: np.array(sorted(v), np.uint64) for n, v in bags_.items()}
    sketches = {n: (bag.signatures(1, np.zeros(len(v), int), bag.X.mix(v), np.ones(len(v), int)) & 0xFF).astype(np.uint8)[0].tobytes() for n, v in packed.items()}
    similar = lambda p, q: bag.enough(bag.overlap(packed[p].tobytes(), packed[q].tobytes()), len(packed[p]), len(packed[q]))
    cross = [(p, q) for p in packed for q in packed if p[:1] == b"0" and q[:1] == b"1" and similar(p, q)]
    assert cross == [(b"0zz", b"1aa")]
    table = spark.createDataFrame([(n, v.tobytes(), sketches[n]) for n, v in packed.items()], "node binary, bag binary, sketch binary")
    members = spark.createDataFrame([(key, band, n, len(v), 100 if n.endswith(b"00") else 20, len(packed)) for n, v in packed.items() for band, key in ((3, 7), (5, 8))],
                                    "key long, band int, node binary, n long, degree long, mates long")
    labels = table.select("node", F.col("node").alias("root"))
    assert {r["root"] for r in bag.linked(members, table, labels).collect()} == {b"000"}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    key = rng.integers(1, 2**63, 60, dtype=np.uint64)
    count = [rng.integers(0, 9, 60), rng.integers(0, 9, 60)]
    count[1][:40] = count[0][:40]
    doc, keys, counts = (np.concatenate(x) for x in zip(*[(np.full(int((c > 0).sum()), d), key[c > 0], c[c > 0]) for d, c in enumerate(count)], strict=True))
    true = np.minimum(*count).sum() / np.maximum(*count).sum()
    sig = bag.signatures(2, doc, keys, counts, 4096)
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * math.sqrt(true * (1 - true) / 4096)


def test_dedup_keeps_one_row_per_class(spark):
    rows = variants(9) + [(3, variants(9)[3][1])] * 2 + [(None, "null id " * 9), (None, "null id " * 9), (None, None)]
    docs = frame(spark, rows).withColumn("row", F.lit(1)).withColumn("node", F.lit(2)).withColumn("_keep", F.lit(3))
    out = bag.without_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = out.select("doc_id").collect()
    groups = brute_classes(variants(9))
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(min(g) for g in groups)
    assert sum(r[0] is None for r in kept) == 1  # the null text joins the class of texts without words
    assert bag.without_near_duplicates(docs.limit(0)).count() == 0


# --- decontamination ---

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_length_matches_dynamic_programme():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        assert decon.common_length(decon.places_of(a), b) == lcs(a, b)


def test_finds_copies_and_paraphrases_only(spark, data):
    items = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").collect()]
    filler = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(4)
    rows, want = [], set()
    for i, item in enumerate(items):
        words = item.split()
        lead = " ".join(filler[i].split()[:60])
        rows.append((10 * i, f"{lead} {item} {lead}"))
        rows.append((10 * i + 1, f"{lead} {item.upper().replace(' ', '*** ')} {lead}"))
        kept = [w if k >= len(words) - 5 or rng.random() > 0.15 else "changed" for k, w in enumerate(words)]
        rows.append((10 * i + 2, f"{lead} {' '.join(kept)} {lead}"))
        rows.append((10 * i + 3, lead))
        rows.append((10 * i + 4, f"{lead} {' '.join(rng.sample(words, len(words)))} {lead}"))
        want |= {(10 * i + k, i) for k in (0, 1, 2)}
    bench = spark.createDataFrame([*enumerate(items), (900, None), (901, ""), (902, "!?")], "item_id long, text string")
    found = decon.matches(frame(spark, rows + [(9001, None), (9002, "")]), bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    natural = {(10 * i + k, j) for i, t in enumerate(filler[: len(items)]) for k in range(5) for j, x in enumerate(items) if x in t}
    assert len(want - got) <= 0.02 * len(want) and not (got - want - natural)
    docs = frame(spark, rows + [(9001, None), (9002, "")]).withColumn("c1", F.lit(1)).withColumn("body", F.lit("z"))
    out = decon.without_benchmark(docs, bench)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {d for d, _ in rows + [(9001, 0), (9002, 0)]} - {d for d, _ in got}
    assert decon.matches(docs.limit(0), bench).count() == 0 and decon.matches(docs, bench.limit(0)).count() == 0


def test_finds_paraphrases_with_many_replaced_words(spark, data):
    items = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").orderBy("item_id").collect()]
    filler = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()]
    rng = random.Random(8)
    rows, want = [], set()
    for i, item in enumerate(items):
        tail = len(decon.answer_words(item).split())
        lead = " ".join(filler[i].split()[:60])
        for k, share in enumerate((0.2, 0.3, 0.4)):
            words = item.split()
            for at in rng.sample(range(len(words) - tail), min(round(share * len(words)), len(words) - tail)):
                words[at] = "".join(rng.choices("abcdefgh", k=7))
            rows.append((10 * i + k, f"{lead} {' '.join(words)} {lead}"))
            want.add((10 * i + k, i))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decon.matches(frame(spark, rows), bench).collect()}
    assert len(want & got) >= 0.97 * len(want)


def test_common_counts_all_at_once():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(n)) + ". end of it" for n in (4, 30, 61, 90)]
    items = decon.index_items([0, 1, 2, 3], texts, np.ones(decon.BUCKETS, np.float32), np.arange(decon.BUCKETS), np.ones((decon.BUCKETS, 1), np.float32))
    hashes = decon.X.terms(pa.array([" ".join(rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(200))]))[3].hash
    item, low = np.repeat(np.arange(4), 20), np.array([rng.randint(0, 100) for _ in range(80)])
    high = low + np.array([rng.randint(1, 100) for _ in range(80)])
    got = items.common(item, hashes, items.numbers(hashes), low, high)
    may = items.may_hold(item, items.numbers(hashes), low, high)
    for c in range(80):
        stretch = hashes[low[c] : high[c]].tolist()
        want = [decon.common_length(x[item[c]], stretch) for x in (items.words, items.answers)]
        assert [got[0][c], got[1][c]] == want
        share, answer = want[0] / items.size[item[c]], want[1] / items.answer_size[item[c]]
        assert may[c] or not (share >= decon.MIN_COMMON or (share >= decon.MIN_PARAPHRASE and answer >= decon.MIN_ANSWER))


def test_latent_space_finds_leading_vectors(spark):
    rng = np.random.default_rng(0)
    topics = [[f"{c}{c}{x}" for x in "abcdefghij"] for c in "klm"]
    rows = [(i, " ".join(rng.choice(topics[i % 3], 96))) for i in range(60)]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(0, " ".join(w for t in topics for w in t))], "item_id long, text string")
    space = decon.fit(docs, bench)
    ids = decon.term_ids(docs)
    place = {c: k for k, c in enumerate(space.columns)}
    matrix = []
    for r in ids.collect():
        terms = np.frombuffer(r["ids"], np.uint16)
        for b in range(0, len(terms), decon.PASSAGE):
            part = terms[b : b + decon.PASSAGE]
            v = np.zeros(len(place))
            np.add.at(v, [place[t] for t in part], space.idf[part])
            matrix.append(v / math.sqrt((space.idf[part].astype(float) ** 2).sum()))
    _, _, vt = np.linalg.svd(np.array(matrix), full_matrices=False)
    overlap = np.linalg.svd(vt[:3] @ space.basis[:, :3], compute_uv=False)
    assert overlap.min() > 0.99


# --- quality field ---

def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(7)
    first = np.array([0, 3, 3, 8, 9])
    score, link, weight = rng.normal(size=9), rng.normal(size=(2, 2)), np.ones(9)
    good, log_total, pairs = crf.forward_backward(score, link, crf.Chains(first), weight)
    want, total, expected = np.zeros(9), 0.0, np.zeros((2, 2))
    for a, b in itertools.pairwise(first):
        z, mass, links = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=int(b - a)):
            p = math.exp(sum(s * x for s, x in zip(states, score[a:b], strict=True)) + sum(link[i, j] for i, j in itertools.pairwise(states)))
            z, mass = z + p, mass + p * np.array(states, float)
            for i, j in itertools.pairwise(states):
                links[i, j] += p
        want[a:b], total, expected = mass / z, total + math.log(z), expected + links / z
    assert np.allclose(good, want) and np.isclose(log_total, total) and np.allclose(pairs, expected)


def test_quality_on_held_out_rows(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    out = QUERIES["op4_quality_classifier"](spark, data).join(labels, "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.95
    flipped = labels.withColumn("quality", F.when(crf.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = crf.train(docs, labels), crf.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights) and a.slope == b.slope


def test_quality_edges(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, " \n "), (None, "good line.\n" * 3000), (4, "x " * 50_000), (4, "x " * 50_000)])
    labels = spark.createDataFrame([(1, 1), (4, 0), (99, 1), (5, None)], "doc_id long, quality int")
    rows = crf.score(docs, crf.train(docs, labels)).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    none = crf.score(docs, crf.train(docs, labels.limit(0)))
    assert {r["score"] for r in none.collect()} == {0.5} and crf.score(docs.limit(0), crf.train(docs.limit(0), labels)).count() == 0


# --- toxicity ---

def test_toxic_documents_are_caught(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}n" for a in "bdfg" for b in "aeiou" for c in "klmr"]
    bad = ["idiot", "scum", "zork", "trash"]
    rows, labels = [], []
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        toxic = i % 6 == 0
        if toxic:
            for w in rng.sample(bad, 2):
                text.insert(rng.randrange(len(text)), w.upper() + "!")
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = frame(spark, rows)
    train_on = spark.createDataFrame([x for x in labels if x[0] // 6 % 3], "doc_id long, toxic int")
    chain = toxicity.train(docs, train_on)
    p = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    held = [x for x in labels if x[0] // 6 % 3 == 0]
    assert sum((p[i]["p_toxic"] >= 0.5) == bool(y) for i, y in held) >= 0.98 * len(held)
    insult = [i for i, t in rows if "IDIOT" in t]
    assert np.mean([p[i]["p_insult"] > 0.5 for i in insult]) > 0.8 and np.mean([p[i]["p_insult"] > 0.5 for i, y in labels if not y]) < 0.02
    assert chain.earlier[-1].any() and not np.triu(chain.earlier).any()


def test_toxicity_edges(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, "idiot " * 40_000), (3, "idiot"), (None, "x")]).withColumn("p_toxic", F.lit(1)).withColumn("c0", F.lit(2))
    labels = spark.createDataFrame([(3, 1), (1, 0), (2, None), (77, 1)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0), labels.where("toxic = 1")):
        chain = toxicity.train(docs, lab)
        out = toxicity.without_toxic(docs, chain)
        assert out.columns == docs.columns and {1, 2} <= {r["doc_id"] for r in out.collect()}
        assert toxicity.score(docs, chain).count() == 5
    assert toxicity.without_toxic(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


# --- token shards ---

@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(3)
    ids = np.concatenate((rng.choice([2, 5, 7, 49_000, 300, 65_000], 3000), np.full(700, 7)))
    ends = np.array([10, 10, 2000, 3700])
    data = tokens.build(ids, ends, pa.array([4, None, 9, 9]))
    small = tokens.BLOCK_BITS
    return ids, tokens.WaveletMatrix(lambda at, n: data[at : at + n]), small


def test_wavelet_matrix(matrix, monkeypatch):
    ids, _, _ = matrix
    monkeypatch.setattr(tokens, "BLOCK_BITS", 512)
    data = tokens.build(ids, np.array([10, 10, 2000, 3700]), pa.array([4, None, 9, 9]))
    m = tokens.WaveletMatrix(lambda at, n: data[at : at + n])
    assert m.doc_ids.to_pylist() == [4, None, 9, 9]
    assert [m.access(i) for i in range(0, 3700, 37)] == ids[::37].tolist() and m.document(0) == ids[:10].tolist() and m.document(1) == []
    for token in (2, 7, 300, 65_000, 6, 1 << 20):
        places = np.flatnonzero(ids == token)
        assert m.rank(token, 3700) == len(places) and m.rank(token, 2500, 511) == ((places >= 511) & (places < 2500)).sum()
        assert [m.select(token, k) for k in range(0, len(places), 50)] == places[::50].tolist() and m.select(token, len(places)) == -1
    assert m.all_ids().tolist() == ids.tolist()


def test_wavelet_matrix_reads_few_blocks(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BITS", 2048)
    monkeypatch.setattr(tokens, "CACHE_BLOCKS", 3)
    ids = np.random.default_rng(8).integers(0, 9, 10_000).astype(np.uint16)
    data = tokens.build(ids, np.array([10_000]), pa.array([1]))
    m = tokens.WaveletMatrix(lambda at, n: data[at : at + n])
    for token in range(9):
        places = np.flatnonzero(ids == token)
        ends = [0, 1, 511, 512, 513, 2047, 2048, 2049, 9_999, 10_000]
        assert [m.rank(token, e) for e in ends] == [int((places < e).sum()) for e in ends]
        assert [m.select(token, k) for k in range(0, len(places), 97)] == places[::97].tolist()
    assert len(m.cached) <= 3 and m.all_ids().tolist() == ids.tolist()


def test_shards_lie_where_spark_reads(spark, data):
    place = tokens.folder(spark, "plain").replace("file:", "")
    shards = tokens.write_shards(spark.read.parquet(f"{data}/documents.parquet"), place, tokens.public_path("word_bpe_49k.json"), 2)
    paths = [r["path"] for r in shards.collect()]
    assert paths and all(p.startswith("file:") for p in paths) and spark.read.format("binaryFile").load(paths).count() == len(paths)


def test_empty_and_single_token_shards():
    for ids in (np.zeros(0, np.uint16), np.array([2], np.uint16), np.full(5, 9, np.uint16)):
        data = tokens.build(ids, np.array([len(ids)]), pa.array(["x"]))
        m = tokens.WaveletMatrix(lambda at, n, d=data: d[at : at + n])
        assert m.all_ids().tolist() == ids.tolist() and m.rank(2, 9) == (ids == 2).sum()


def test_encoder_equals_the_library():
    path = tokens.public_path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "É", "'s", "'", "!", "1", "½", " ", "\n", "\t", "\xa0", "\x1c", "é", "Σ", "ς", "日本", "🙂", "<|endoftext|>", "<|", "ß", "İ", "µ", "ª", "́", "'Re", "."]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(3000)] + ["", " ", "x" * 9000]
    code = tokens.Encoder(path)
    want = [np.array(e.ids, code.dtype).tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert code.pieces is not None and code.encode(texts) == want and code.encode(texts[::-1]) == want[::-1]
    other = tokens.Encoder(tokens.public_path("byte_bpe_50k.json"))
    assert other.pieces is None and len(other.encode(["Hello  world"])[0]) == 3 * other.dtype.itemsize


def test_token_table(spark, data, monkeypatch):
    import zlib

    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CACHE_PARTS", 500)
    path = tokens.public_path("word_bpe_49k.json")
    docs = frame(spark, [(None, None), (-5, "x y"), (3, ""), (3, "b"), (3, "b")]).unionByName(spark.read.parquet(f"{data}/documents.parquet"), True)
    shards = tokens.write_shards(docs.withColumn("tie", F.lit(0)).withColumn("body", F.lit(1)), f"{tokens.folder(spark, 'test')}", path, 2, shard_bytes=40_000)
    assert shards.count() > 3
    rows = sorted(tokens.read_documents(shards).collect(), key=lambda r: r["start"])
    source = collections.defaultdict(list)
    t = Tokenizer.from_file(path)
    for r in docs.collect():
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        source[r["doc_id"]].append((len(ids), zlib.crc32(ids.tobytes())))
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in docs.select("doc_id").collect()), key=lambda x: -math.inf if x is None else x)
    assert np.cumsum([0, *[r["n_tokens"] for r in rows]])[:-1].tolist() == [r["start"] for r in rows]
    got = collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in source.items()}
    assert tokens.token_table(docs.limit(0), path, 2).count() == 0


# --- quality rules ---

def test_host_verdicts(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "spam"
    rows = [(i, good, None, "clean") for i in range(90)] + [(100 + i, bad, None, "clean") for i in range(3)]
    rows += [(200 + i, bad, None, "foul") for i in range(80)] + [(300, good, None, "foul"), (400, bad, None, "one"), (500, good, None, None), (None, None, None, None)]
    out = {r["doc_id"]: r for r in quality_rules.judge(frame(spark, rows).withColumn("host", F.lit("zz")).withColumn("body", F.lit(0))).collect()}
    assert len(out) == len(rows) and out[0]["kept"] and out[500]["kept"]
    assert not out[300]["base_failed"] and out[300]["host_rejected"] and not out[300]["kept"] and not out[400]["kept"]
    assert out[400]["shrunk_rate"] < 1 and out[None]["n_words"] == 0 and out[None]["base_failed"]
    assert quality_rules.judge(frame(spark, rows).limit(0)).count() == 0


# --- pages ---

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1><p>by me</p></header><p><b>One  <i>two</i>
three<br>four<p>Caf&eacute; &lt;b&gt; 5 &lt; 6 &#8212; x<div class="ad">buy</div><aside>side</aside><blockquote>quote</blockquote>
<form><input><p>mail me</p></form><!-- gone <p>x</p> --><section id="comments"><p>first!</p></section>tail</article>
<footer>&copy; me</footer></body></html>"""


def test_article_of_a_page():
    text, tokens_, _ = extraction.main_texts([extraction.blocks_of(PAGE)])[0]
    assert text == "Head & line\n\nOne two three four\n\nCafé <b> 5 < 6 — x\n\nquote\n\ntail" and tokens_ > 20
    for part in ("", "<", "<p", "<p>a", "</p></div>", "<script>x", "<b><p>q</b>r", "<div><div class='ad'>z", '<p title="a>b', "a < b", None):
        extraction.main_texts([extraction.blocks_of(part)])
    assert extraction.main_texts([extraction.blocks_of("<p>a<b>c</b>d</p> e")])[0][0] == "acd\n\ne"


def test_repeats_match_brute_force():
    rng = np.random.default_rng(6)
    for depth in (2, 3, 5, 12):
        page = np.sort(rng.integers(0, 5, 300))
        token = rng.integers(0, 3, 300).astype(np.uint64)
        token[page == 4] = 7
        if depth == 12:
            token[:60], token[200:240] = np.arange(60), np.arange(10, 50)
        copy = np.where(page == 1, 0, page)
        got = extraction.repeats(page, token, copy, depth)
        runs = collections.defaultdict(set)
        for i in range(300 - depth + 1):
            if page[i] == page[i + depth - 1]:
                runs[tuple(token[i : i + depth])].add(copy[i])
        want = np.zeros(300, bool)
        for i in range(300 - depth + 1):
            if page[i] == page[i + depth - 1] and len(runs[tuple(token[i : i + depth])]) > 1:
                want[i : i + depth] = True
        assert np.array_equal(got, want)


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    frame_ = "<div>Welcome to the best shop for every kind of small wooden garden furniture since nineteen hundred and three</div>"
    body = lambda i: " ".join(f"own{i}x{k}" for k in range(40))
    rows = [(i, f"http://shop.example/{i}", f"<body>{frame_}<p>{body(i)}</p>{frame_}") for i in range(70)]
    rows += [(100 + k, "http://copy.example/a", f"<p>{body(999)}</p>") for k in range(2)] + [(200, None, None), (201, "x", ""), (None, "http://lone.example", f"<body>{frame_}")]
    rows.append(rows[0])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).withColumn("text", F.lit("t"))
    out = extraction.extract(pages).collect()
    got = {r["page_id"]: r for r in out}
    assert len(out) == len(rows) and all(got[i]["text"] == body(i) and got[i]["n_chars"] == len(body(i)) for i in range(70))
    assert got[100]["text"] == body(999) and got[200]["text"] == "" and got[201]["n_chars"] == 0 and got[None]["text"].startswith("Welcome")
    assert got[1]["n_repeated"] > 0 and extraction.extract(pages.limit(0)).count() == 0


def test_what_a_host_repeats_is_found_between_arrays(spark, monkeypatch):
    """A host dealt to many arrays gives the same as one array: frames on two pages only, runs of just the least length, copies, marked pages."""
    rng = np.random.default_rng(8)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    rare, least, short = words(30), words(extraction.MIN_RUN - 1), words(extraction.MIN_RUN - 2)
    rows = [(i, "http://h.example/a", f"<p>{words(50)}</p>" + (f"<div>{rare}</div>" if i in (3, 44) else f"<div>{least}</div>" if i in (5, 50) else
             f"<p>{short}</p>" if i in (6, 51) else "")) for i in range(60)]
    rows += [(100 + i, "http://h.example/b", f"<p>{rare[:0]}same {' '.join(map(str, range(40)))}</p>") for i in range(9)]
    rows += [(200 + i, f"http://h.example/{i}", f"<article><p>{words(20)}</p></article><p>{rare}</p>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").persist()
    got = {}
    for size in (3, 1000):
        monkeypatch.setattr(extraction, "PAGES_PER_ARRAY", size)
        got[size] = sorted(map(tuple, extraction.extract(pages).collect()))
    assert got[3] == got[1000]
    by = {r[0]: r for r in got[3]}
    assert rare not in by[3][2] and rare not in by[44][2] and least not in by[5][2] and short in by[6][2]
    assert by[6][5] == by[100][5] == by[0][5] == 0 and by[5][5] == extraction.MIN_RUN - 1 and by[200][5] == 30 and by[100][2].startswith("same 0 1")


def test_counts_added_up_once_drop_most_candidates_and_lose_none(data, monkeypatch):
    """With the tables of words by items and without them a search finds the same, and with them few candidates are looked at word by word."""
    bench, docs = (pq.read_table(f"{data}/{name}.parquet", columns=["text"])["text"].combine_chunks() for name in ("benchmark", "documents"))
    texts = pa.array([*docs.to_pylist()[:60], *bench.to_pylist()[:20], None, "", " ".join(bench.to_pylist()[:40])])
    columns = np.unique(decon.X.terms(bench)[3].hash >> np.uint64(48)).astype(np.int64)
    idf, basis = np.ones(decon.BUCKETS, np.float32), np.abs(np.random.default_rng(1).standard_normal((len(columns), 24))).astype(np.float32)
    items = decon.index_items(list(range(len(bench))), bench.to_pylist(), idf, columns, basis)
    seen, place = [0], decon.pair_place
    monkeypatch.setattr(decon, "pair_place", lambda item, word, size: seen.__setitem__(0, seen[0] + len(item)) or place(item, word, size))
    few, with_tables = decon.search(texts, items, idf, columns, basis), seen[0]
    items.member = items.entry = None
    assert decon.search(texts, items, idf, columns, basis) == few and len(few) >= 20
    assert with_tables < 0.5 * (seen[0] - with_tables)
    monkeypatch.setattr(decon, "MEMBER_BYTES", 0)
    assert decon.index_items([0], bench.to_pylist()[:1], idf, columns, basis).member is None


def test_sums_and_totals_in_small_steps_are_the_same():
    rng = np.random.default_rng(2)
    table, index, value = rng.standard_normal((50, 9)).astype(np.float32), rng.integers(0, 50, 5000), rng.random(5000).astype(np.float32)
    head = np.unique(np.append(0, rng.integers(0, 3000, 900)))  # the last segment is longer than a step
    assert np.array_equal(decon._segment_sums(table, index, value, head), np.add.reduceat(table[index] * value[:, None], head, axis=0))
    for n in (0, 1, 64, 65, 1000):
        counts = rng.integers(0, 255, (n, 5)).astype(np.uint8)
        want = np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(counts, axis=0, dtype=np.int64)))
        assert np.array_equal(decon._running_totals(counts)[: n + 1], (want % (1 << 16)).astype(np.uint16))


def test_search_in_blocks_of_any_size_aligns_once(data, monkeypatch):
    """Blocks of runs share their sums between window sizes and lose nothing where they meet; the candidates of all blocks are aligned in one call."""
    bench, docs = (pq.read_table(f"{data}/{name}.parquet", columns=["text"])["text"].combine_chunks() for name in ("benchmark", "documents"))
    texts = pa.array([*docs.to_pylist()[:300], *bench.to_pylist()[:20], "one two", None, ""])
    columns = np.unique(decon.X.terms(bench)[3].hash >> np.uint64(48)).astype(np.int64)
    idf, basis = np.ones(decon.BUCKETS, np.float32), np.abs(np.random.default_rng(1).standard_normal((len(columns), 24))).astype(np.float32)
    items = decon.index_items(list(range(len(bench))), bench.to_pylist(), idf, columns, basis)
    calls, common, got = [], decon.Items.common, {}
    monkeypatch.setattr(decon.Items, "common", lambda *args: calls.append(len(args[1])) or common(*args))
    for runs in (8, 56, 1 << 12):
        monkeypatch.setattr(decon, "RUNS", runs, raising=False)
        got[runs] = [(d, i, common, answer) for d, i, _, common, answer in decon.search(texts, items, idf, columns, basis)]
    assert len(calls) == 3
    assert got[8] == got[56] == got[1 << 12] and len(got[8]) >= 20


def test_sums_side_by_side_and_numbers_by_bucket():
    rng = np.random.default_rng(4)
    size = np.append(rng.integers(0, 40, 1500), [0, 0])
    table, index = rng.standard_normal((50, 9)).astype(np.float32), rng.integers(0, 50, int(size.sum()))
    want = np.array([table[part].sum(axis=0) for part in np.split(index, np.cumsum(size)[:-1])])
    assert np.allclose(decon._piece_sums(table, index, size), want, atol=1e-4)
    text = " ".join(f"{a}{b}{c}{d}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx" for d in "yzabcd")  # some words share a bucket
    items = decon.index_items([0], [text], np.ones(decon.BUCKETS, np.float32), np.arange(decon.BUCKETS), np.ones((decon.BUCKETS, 1), np.float32))
    hashes = decon.X.terms(pa.array([text + " foreign words and more"]))[3].hash
    numbers = items.numbers(hashes)
    assert items.crowded.any() and (items.vocabulary[numbers[:-4]] == hashes[:-4]).all() and (numbers[-4:] == -1).all()


def test_shards_are_built_and_read_in_little_memory():
    """Beside the ids, building and reading a shard holds a few bytes an id: no index of eight bytes an id."""
    import tracemalloc

    ids = (np.random.default_rng(3).zipf(1.3, 3_000_000) % 49_000).astype("<u2")
    ends, names, peaks = np.array([1_000_000, 3_000_000]), pa.array([1, 2]), []
    for step in (lambda: tokens.build(ids, ends, names), lambda: tokens.WaveletMatrix(lambda at, n: data[at : at + n]).all_ids()):
        tracemalloc.start()
        data = step() if not peaks else data
        back = step() if peaks else None
        peaks.append(tracemalloc.get_traced_memory()[1] / len(ids))
        tracemalloc.stop()
    assert np.array_equal(back, ids) and peaks[0] < 12 and peaks[1] < 9


def test_arrow_rows_holds_inside_only(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, sizes = spark.conf.get(name), lambda: spark.range(0, 3000, 1, 1).mapInArrow(
        lambda batches: (b.slice(0, 1).set_column(0, "id", pa.array([b.num_rows])) for b in batches), "id long").collect()
    with arrow_rows(spark, 512):
        inside = [r[0] for r in sizes()]
        with arrow_rows(spark, 4096):
            assert spark.conf.get(name) == "512"
    assert max(inside) <= 512 and sum(inside) == 3000 and spark.conf.get(name) == before
