import hashlib
import random
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.llm import prefix_trie, turn_repair

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
SPACE = " \t\n\x0b\x0c\r"


def talk(seed: int, convs: int, most: int, odd: float = 0.15):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randrange(1, most)):
            role = ["user", "assistant"][t % 2] if r.random() > odd else r.choice(["system", "user", "assistant", "tool", None, "", "User"])
            text = r.choice(["ok.", "ok.", "Why?", "no end", " \t", "", None, f"words {r.randrange(30)}.", "é!", "dot. space \n", " "])
            rows.append((c, t if r.random() > odd / 3 else r.choice([None, t, t + 3]), role, text))
    return rows


def key(row):
    return (row[1] is not None, row[1] or 0, row[2], row[3])


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if n == 1:
            text = ""
        if n == 2:
            text = "".join(x for x in text if x not in ".!?")
        if n == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if n == 0 else 2 if n == 3 else 1)
    return out


def brute_repair(rows):
    """Each conversation's result by dynamic programming over whole edit strings."""
    found = {c: [] for c in by_conversation(rows)}
    found.update(by_conversation(damaged(rows)))
    out = {}
    for c, rs in found.items():
        rs = sorted(rs, key=key)
        seen, faults = set(), []
        for _, _, role, text in rs:
            body = text.strip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))

        @cache
        def best(i, last, depth=0):
            """(cost, edits, lines) from row i on; ``last``: initials so far as one of '', s, u, a."""
            ways = []
            if i == len(rs) and last in ("", "a"):
                ways.append((0, "", ()))
            if depth < 3:
                to = "a" if last == "u" else "u"
                cost, letters, lines = best(i, to, depth + 1)  # noqa: B023
                ways.append((cost + 3, "I" + letters, ("assistant:" if to == "a" else "user:", *lines)))
            if i < len(rs):
                role, text, fault = rs[i][2], rs[i][3], faults[i]  # noqa: B023
                cost, letters, lines = best(i + 1, last)  # noqa: B023
                ways.append((cost + 4, "D" + letters, lines))
                if fault not in ("blank", "duplicate"):
                    more = 3 * (fault == "truncated")
                    if (last, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                        cost, letters, lines = best(i + 1, role[:1])  # noqa: B023
                        ways.append((cost + more, "K" + letters, (role + ":" + text, *lines)))
                    to = "a" if last == "u" else "u"
                    cost, letters, lines = best(i + 1, to)  # noqa: B023
                    ways.append((cost + 3 + more, "R" + letters, (("assistant:" if to == "a" else "user:") + text, *lines)))
            return min(ways) if ways else (10**9, "", ())

        cost, audit, lines = best(0, "")
        turns = [t for _, t, _, _ in rs if t is not None]
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rs, rs[1:], strict=False))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                  faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_repair_equals_brute_force(spark, size):
    rows = talk(1, 120, 14) + [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (-7, None, None, None), (500, None, "system", "x.")]
    got = turn_repair.repair(spark.createDataFrame(rows, CONV).repartition(3), size)
    want = brute_repair(rows)
    have = repaired(got)
    assert have.keys() == want.keys()
    for c in want:
        assert have[c] == want[c], c


def test_one_long_conversation_over_many_pieces(spark):
    """Speculative vectors are wrong at some cuts; fix-up passes mend them."""
    r = random.Random(4)
    kinds = [("system", "s."), ("tool", "cut"), ("user", ""), ("user", "u."), ("assistant", "a.")]
    rows = []
    for t in range(400):
        role, text = kinds[1] if 60 < t < 330 else r.choice(kinds)
        rows.append((7, t, role, text.replace(".", f"{t}.") if "." in text else text and text + str(t)))
    rows += talk(2, 30, 6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turn_repair.repair(spark.createDataFrame([x for x in rows if x[0] != 7] + [x for x in rows if x[0] == 7], CONV), 8)
        have = repaired(got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.passes >= 1
    import sys
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        want = brute_repair([x for x in rows if x[0] == 7 or x in rows])
    finally:
        sys.setrecursionlimit(limit)
    assert have == want


def test_repair_empty_table_extra_columns(spark):
    assert turn_repair.repair(spark.createDataFrame([], CONV)).count() == 0
    rows = talk(3, 20, 6)
    df = spark.createDataFrame(rows, CONV)
    clash = df
    for c in ("pos", "code", "chunk", "piece", "copy", "r", "kind", "cost", "audit", "h1", "first"):
        clash = clash.withColumn(c, F.lit("clash"))
    assert repaired(turn_repair.repair(clash)) == brute_repair(rows)


def brute_trie(rows):
    convs = {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
             for c, rs in by_conversation(rows).items() if c is not None}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    members = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(tuple(built[c][:d]), []).append(c)
    out = []
    for node, who in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in who if len(built[c]) == len(node))
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in below) for n in below)
        saved = sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below)
        out.append((who[0], len(node), members[node[:-1]][0] if node else None, len(who), len(children), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def nodes(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("most", [3, 9, 24])
def test_trie_equals_brute_force(spark, most):
    rows = talk(most, 130, most)
    rows += [(c + 200, t, role, text) for c, t, role, text in rows if c < 60 and c % 3]  # copies: shared branches
    rows += [(None, 1, "user", "no id"), (1000, None, None, None), (1001, 5, "user", "alone")]
    got = prefix_trie.trie(spark.createDataFrame(rows, CONV).repartition(3))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert nodes(got) == brute_trie(rows)


def test_trie_many_ends_at_one_node(spark):
    rows = [(100 * c, t, "user", f"t{t}") for c in range(700) for t in range(3)]
    got = prefix_trie.trie(spark.createDataFrame(rows, CONV))
    assert nodes(got) == brute_trie(rows)
    members, _ = prefix_trie.prefixes(*prefix_trie.rebuilt(prefix_trie.turns(spark.createDataFrame(rows, CONV))))
    small = {tuple(r) for r in prefix_trie.ends(members, chunk=7).collect()}
    assert small == {tuple(r) for r in prefix_trie.ends(members).collect()}


def test_trie_empty_table_extra_columns(spark):
    assert prefix_trie.trie(spark.createDataFrame([], CONV)).count() == 0
    rows = talk(5, 20, 6)
    clash = spark.createDataFrame(rows, CONV)
    for c in ("i", "d", "h", "base", "n1", "s1", "size", "chars", "owner", "piece"):
        clash = clash.withColumn(c, F.lit("clash"))
    assert nodes(prefix_trie.trie(clash)) == brute_trie(rows)
