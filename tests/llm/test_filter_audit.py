import itertools
import random
import re

from adlake.llm import filter_audit as A


def fails(text, doc_id, rows):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 200 else ""
    out += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else ""
    out += "D" if re.search(r"[#$%&*|]", text) else ""
    return out + ("E" if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows) else "")


def brute(rows, labels):
    out = {}
    docs = [((p or ""), fails(t or "", i, rows), any(la[0] == i and la[1] == 1 for la in labels if i is not None), any(la[0] == i and la[2] == 1 for la in labels if i is not None)) for i, t, p in rows]
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                out[part, "".join(order), step] = [f, len(left), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == f for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    total = {}
    for (part, _, _), v in out.items():
        total[part, v[0]] = total.get((part, v[0]), 0) + v[2]
    return {k: (*v, total[k[0], v[0]]) for k, v in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "x", True) for i, t, p in rows], "doc_id long, text string, lang string, mask string, is_first boolean")
    got = A.audit(docs, spark.createDataFrame([(*la, 9) for la in labels], "doc_id long, quality int, toxic int, n int")).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got}
    assert len(got) == len(found)
    assert found == brute(rows, labels)


def test_against_brute_force(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=4))
    texts = [" ".join(word() for _ in range(rng.choice([30, 199, 200, 260]))) for _ in range(25)]
    texts += [" ".join(["one two"] * 150), "\x0b\t\r\n \x0c", "", "é漢😀 Ä", "A", " ".join(texts[0].split()[:100] * 3), "x" * 200_000]
    rows = []
    for i in range(160):
        t = rng.choice(texts)
        t = rng.choice([t, t, t + " #", t.upper(), t + "|", t.replace(" ", " ", 3), "X" + t])
        rows.append((i if rng.random() < 0.9 else None, t, rng.choice(["en", "de", "", None, "zz"])))
    rows += [(3, None, "en"), (3, "", "de"), (7, rows[7][1], "en"), (7, rows[8][1], None), (None, None, None)] + rows[:9]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    check(spark, rows, labels)


def test_empty_and_single(spark):
    check(spark, [], [])
    check(spark, [(5, None, None)], [])


def test_states_of_a_walk_equal_counts():
    rng = random.Random(1)
    for size in range(1, 7):
        cells = {m: (rng.randrange(9), rng.randrange(3)) for m in rng.sample(range(1 << size), (1 << size) // 2 + 1)}
        states = A.subset_states(cells, size)
        for s in range(1 << size):
            alive = [c for m, c in cells.items() if not m & s]
            assert states[s].tolist() == [sum(c[k] for c in alive) for k in range(2)]
