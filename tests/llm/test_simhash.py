import random
import re

import xxhash

from joblark.llm import simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_fingerprint():
    for text in (None, "", " \n", "One", "a b c", "A b C d", "É a b\x0bc\td e f é", "x " * 50, "w1 w2 w3 w4 w5 W1 w2"):
        assert simhash.fingerprint((text or "").encode()) == brute_print(text)
    rng = random.Random(1)
    for _ in range(30):
        text = " ".join(rng.choice("abc É de f".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(4, 9000 if _ == 3 else 90)))
        assert simhash.fingerprint(text.encode()) == brute_print(text)


def near(rng, fp, flips):
    for b in rng.sample(range(64), flips):
        fp ^= 1 << b
    return fp


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(2)
    fps = [0]
    for _ in range(60):
        base = rng.getrandbits(64)
        fps += [base, *(near(rng, base, rng.randint(1, 6)) for _ in range(rng.randint(0, 5)))]
    for base in (0, rng.getrandbits(64)):  # crowds
        fps += [near(rng, base, rng.randint(0, 3)) for _ in range(150)]
    chain = rng.getrandbits(64)
    for b in range(0, 64, 4):
        chain ^= 0b1111 << b
        fps.append(chain)
    fps = sorted(set(fps), key=signed)
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    edges = simhash.links(df, crowd=8)
    for r in edges.collect():
        assert 0 < ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 4
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = brute_components(fps)
    assert [got.get(signed(f), signed(f)) for f in fps] == [signed(fps[w]) for w in want]


def test_documents(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(0, 400))]
        rows.append((i, " ".join(text)))
        for k in range(rng.randint(0, 2)):
            other = list(text)
            if other:
                other[rng.randrange(len(other))] = "edited"
            rows.append((1000 + 10 * i + k, " ".join(other)))
    rows += [(500, None), (501, ""), (502, " \t"), (None, rows[3][1]), (3, rows[3][1]), (7, "Same"), (700, "same")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, component_id string").repartition(4)
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    order = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    fps = [brute_print(t) for _, t in order]
    want = [(d, signed(f), order[r][0]) for (d, _), f, r in zip(order, fps, brute_components(fps))]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_first_rows_keep_one_row_of_each_component(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(30):
        text = [rng.choice(words) for _ in range(rng.randint(0, 300))]
        rows += [(i, " ".join(text), "a"), (100 + i, " ".join([*text, "more"]), "b"), (200 + i, " ".join(text).upper(), "c")]
    # different texts under one id, rows alike in all columns, no id, no words
    rows += [(5, "another text of five", "a"), (400, "a text under two ids", "a"), (401, "a text under two ids", "b"), (401, "quite another", "a")]
    rows += [rows[7], (None, rows[6][1], "n"), (None, "of no id", "n"), (500, None, "n"), (501, "", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string").repartition(4)
    got = simhash.first_rows(df)
    assert got.columns == df.columns
    order = sorted(set(rows), key=lambda r: -(2**63) if r[0] is None else r[0])
    root = brute_components([brute_print(t) for _, t, _ in order])
    groups = {}
    for i, r in enumerate(order):
        groups.setdefault(root[i], []).append(r)
    kept = [tuple(r) for r in got.collect()]
    assert len(kept) == len(set(kept)) == len(groups)
    for members in groups.values():
        one = [r for r in kept if r in members]
        assert len(one) == 1 and one[0][0] == members[0][0]
    assert {"another text of five", "quite another", "of no id"} <= {r[1] for r in kept}
    assert simhash.first_rows(df.limit(0)).count() == 0
