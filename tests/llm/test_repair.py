"""Structure repair against a plain search over all edits."""

import functools
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from treelab.llm import repair

ROLES = ["system", "user", "assistant", "tool", "User", "", None, "sys", "user", "assistant", "user", "assistant"]
TEXTS = ["Hi.", "no end", "", " \t\n", None, "a? ", "b!\x0b", "Hi.", "x.\x85", "ü", "."]
CONV = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        kind = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def plain(rows):
    """Counts, cost, audit and repaired lines by trying every edit at every place."""
    kinds = faults(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            cost, audit, lines = best(i, due[state], inserted + 1)
            ways.append((cost + 5, "I" + audit, (full[due[state]] + ":", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit, lines))
            if kinds[i] not in ("blank", "duplicate"):
                more = 5 * (kinds[i] == "truncated")
                if (state, role[:1]) in after:
                    cost, audit, lines = best(i + 1, after[state, role[:1]], 0)
                    ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, due[state], 0)
                ways.append((cost + more + 1, "R" + audit, (f"{full[due[state]]}:{text}", *lines)))
        return min(ways) if ways else (10**9, "", ())

    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "sha": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def test_reports_and_repaired_rows(spark):
    random.seed(7)
    given = []
    for c in [None, *range(120)]:
        for _ in range(random.choice([1, 2, 3, 6, 14])):
            given.append((c, random.choice([None, 0, 1, 2, 5, 9, 9]), random.choice(ROLES), random.choice(TEXTS)))
    given += [given[-1]] * 4
    random.shuffle(given)
    frame = spark.createDataFrame([(*g, "x", 1) for g in given], CONV + ", audit string, tag int").repartition(5)
    rows = repair.rows_of(frame)
    reports = repair.report(rows)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.text_digests(repair.repaired(rows, reports)).collect()}
    got = {r["conv_id"]: r for r in reports.collect()}
    by_conv = {}
    for c, t, role, text in given:
        by_conv.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    assert set(got) == set(by_conv)
    for c, mine in by_conv.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        want = plain(mine)
        sha = want.pop("sha")
        assert {k: got[c][k] for k in want} == want
        assert digests.get(c, hashlib.sha256(b"").hexdigest()) == sha
    edits = repair.repaired(rows, reports).groupBy("conv_id").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("place", "edit"))), lambda e: e["edit"])).alias("e"))
    for r in edits.collect():
        assert r["e"] == got[r["conv_id"]]["audit"].replace("D", "")


def test_audits_of_long_and_short_together():
    random.seed(2)
    convs = [[random.choice(range(12)) for _ in range(n)] for n in (0, 1, 300, 2, 0, 5000, 7)] + [[3, 6] * 20_000]
    codes, begin = np.array([x for c in convs for x in c]), np.cumsum([0, *map(len, convs)])
    together = repair.audits(codes, begin, repair.CostTable())
    for i, c in enumerate(convs):
        cost, audit = repair.audits(np.array(c, np.int64), np.array([0, len(c)]), repair.CostTable())
        assert (together[0][i], together[1][i]) == (cost[0], audit[0])
    assert together[1][-1] == b"K" * 40_000 and together[0][-1] == 0


@pytest.mark.parametrize("size", [7, 10_000])
def test_conversations_cross_batches(spark, size):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        rows = repair.rows_of(spark.createDataFrame([(c, t, ["user", "assistant"][t % 2], f"t{t}.") for c in (1, 2, 3) for t in range(40)], CONV).coalesce(1))
        out = repair.report(rows)
        assert sorted((r["conv_id"], r["audit"], r["n_rows"]) for r in out.collect()) == [(c, "K" * 40, 40) for c in (1, 2, 3)]
        want = hashlib.sha256("\n".join(f"{['user', 'assistant'][t % 2]}:t{t}." for t in range(40)).encode()).hexdigest()
        assert {r["repaired_sha256"] for r in repair.text_digests(repair.repaired(rows, out)).collect()} == {want}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_and_long(spark):
    rows = repair.rows_of(spark.createDataFrame([(1, 0, "user", "x" * 2_000_000 + "."), (1, 1, "assistant", "y.")], CONV))
    assert repair.report(rows).first()["audit"] == "KK"
    none = rows.limit(0)
    assert repair.report(none).collect() == [] and repair.text_digests(repair.repaired(none, repair.report(none))).collect() == []
