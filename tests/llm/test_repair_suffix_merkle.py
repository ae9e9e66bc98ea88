"""Conversation repair, suffix dedup and the Merkle manifest against plain Python, on hostile rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from chronolith.llm import chat_repair, merkle, suffix_dedup
from chronolith.llm.order import numbered
from pyspark.sql import functions as F

SPACE = "[^\\x20\\x09-\\x0D]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# conversation repair


def brute_repair(rows, damage=True):
    """rows: (conv_id, turn, role, text). A backward search over whole suffixes: (cost, audit, entries)."""
    out = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            if hit == 0:
                continue
            text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
            kept += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in kept:
            last = re.findall(SPACE, text)
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else "")
            seen.add((role, text))
        best = {0: (0, "", ()), 1: (6, "II", ("user:", "assistant:")), 2: (3, "I", ("assistant:",)), 3: (0, "", ())}
        step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
        for (_, role, text), fault in reversed(list(zip(kept, faults, strict=True))):
            here, late = {}, 3 if fault == "truncated" else 0
            for q in range(4):
                options = [(4 + best[q][0], "D" + best[q][1], best[q][2])]
                if fault not in ("blank", "duplicate"):
                    given, to = step[q]
                    options.append((3 + late + best[to][0], "R" + best[to][1], (f"{given}:{text}", *best[to][2])))
                    for initial, state in [(given[0], to)] + ([("s", 1)] if q == 0 else []):
                        if role[:1] == initial:
                            options.append((late + best[state][0], "K" + best[state][1], (f"{role}:{text}", *best[state][2])))
                here[q] = min(options)
            for _ in range(3):
                for q in range(4):
                    given, to = step[q]
                    here[q] = min(here[q], (3 + here[to][0], "I" + here[to][1], (f"{given}:", *here[to][2])))
            best = here
        initials, turns = [r[1][:1] for r in kept], [r[0] for r in kept if r[0] is not None]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, entries = best[0]
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(entries).encode()).hexdigest())
    return out


CHAT = "turn long, conv_id long, cost long, role string, text string, block int, pos long"


def chat_frame(spark, rows):
    return spark.createDataFrame([(t, c, 7, r, x, 1, 2) for c, t, r, x in rows], CHAT)


def chats():
    rng = random.Random(3)
    rows = []
    for conv in [*range(12), None]:
        for k in range(rng.randrange(1, 40)):
            text = rng.choice(["Hello there.", "so it is", "", None, " \t", "yes!", "why?  ", f"line {k}.", "größe 日本."])
            rows.append((conv, rng.choice([k, k, k, None, k - 1]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), text))
    rows += [(50, k, "user", f"all users {k}.") for k in range(60)]  # no state is ever forgotten
    rows += [(51, k, "user", "the same.") for k in range(30)]  # all but one must go
    rows += [(52, 0, "user", "w " * 200_000 + "end.")]
    return rows


def result(df):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[c] for c in columns) for r in df.collect()}
    return got


@pytest.mark.parametrize(("chunk", "damage"), [(4, True), (256, True), (3, False)])
def test_repair_equals_brute_force(spark, chunk, damage):
    rows = chats()
    assert result(chat_repair.repaired(chat_frame(spark, rows), chunk, damage)) == brute_repair(rows, damage)


def test_repair_of_nothing(spark):
    assert chat_repair.repaired(chat_frame(spark, [])).collect() == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert result(chat_repair.repaired(chat_frame(spark, [(gone, 0, "user", "Hi.")]))) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_speculative_vectors_span_all_costs_to_go():
    """Every row maps vectors within the bounds to such, so that four results that differ by constants settle a chunk."""
    bound = chat_repair.BOUNDS
    inside = lambda v: (v <= (bound + v[None]).min(axis=1)).all()
    assert inside(chat_repair.END)
    for code in range(16):
        assert all(inside(v) for v in chat_repair.back(np.full(4, code), bound.T.copy()))


# suffix dedup


def brute_removed(docs, size=50):
    """docs: (doc_id, text). Strings by the smallest document that holds them."""
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    for d, b in raw:
        if d is not None:
            for i in range(len(b) - size + 1):
                s = b[i : i + size]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, b in raw:
        hit = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - size + 1):
                if first[b[i : i + size]] < d:
                    hit[i : i + size] = b"\x01" * size
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        out.append((d, len(b), sum(hit), len(re.findall(rb"\x01+", bytes(hit))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def suffix_docs(texts):
    rng = random.Random(9)
    shared = " ".join(f"p{rng.randrange(90)}" for _ in range(60))
    extra = [f"{'x' * k} {shared} {'y' * (2 * k)} tail {k}" for k in range(15)]
    extra += ["a" * 400, "a" * 49, "a" * 50, "ab" * 300, "b" + "ab" * 120, "ä" * 60, "x" + "ä" * 60, shared[:49], shared[:50], shared[7:57], shared * 3]
    return [t for t in texts if t is None or len(t) < 20_000] + extra


def test_removed_equals_brute_force(spark, texts):
    docs = [(100 - i if i % 3 else i * 2, t) for i, t in enumerate(suffix_docs(texts))]
    docs += [(None, docs[3][1]), (None, docs[3][1]), docs[5], (docs[6][0], docs[7][1])]
    frame = spark.createDataFrame([(1, d, 2, t, 3) for d, t in docs], "bucket int, doc_id long, gone int, text string, ids int").repartition(5)
    rows = suffix_dedup.removed(frame).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows), key=repr) == brute_removed(docs)


def test_removed_in_small_blocks_and_steps(spark, texts, monkeypatch):
    """Runs, blocks and steps may be cut anywhere: the result stays."""
    docs = list(enumerate(suffix_docs(texts)[-40:]))
    whole = suffix_dedup.Runs(*laid([t for _, t in docs]))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 97)
    cut = suffix_dedup.Runs(*laid([t for _, t in docs]))
    strings = lambda r: sorted(zip(*[x.tolist() for x in r.strings(np.ones(len(r.doc), bool))], strict=True))
    assert strings(whole) == strings(cut)
    assert len(strings(whole)) == sum(max(0, len((t or "").encode()) - 49) for _, t in docs)


def laid(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(b) for b in raw])))


def test_removed_of_nothing_and_a_long_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.removed(none).collect() == []
    long_ = " ".join(f"n{i}" for i in range(150_000))
    rows = {r["doc_id"]: r for r in suffix_dedup.removed(spark.createDataFrame([(1, long_), (2, "head " + long_[1000:900_000] + " tail"), (3, None)], "doc_id long, text string")).collect()}
    assert rows[1]["n_removed"] == 0 and rows[3]["n_bytes"] == 0
    assert (rows[2]["n_removed"], rows[2]["n_spans"]) in {(899_000 + k, 1) for k in range(3)}


def test_settings_are_restored(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    suffix_dedup.removed(spark.createDataFrame([(1, "t")], "doc_id long, text string")).collect()
    assert spark.conf.get(name, None) == before


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def part(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grown(nodes, fanout):
    """The root, and for each node what stands beside it at each level."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for a in range(0, len(nodes), fanout):
            run = nodes[a : a + fanout]
            for k in range(len(run)):
                for i in under[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(H(*run))
            below.append(sum(under[a : a + fanout], []))
        nodes, under = up, below
    return nodes[0], paths


def brute_manifest(rows, fanout=8):
    leaf = lambda r, text: H(*map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))
    langs = {}
    for r in rows:
        tampered = r["text"].translate(LOWER) if r["text"] is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 else r["text"]
        langs.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, tampered), r["doc_id"]))
    trees, out = [], []
    for lang in sorted(langs, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(langs[lang])
        trees.append((own, *grown([x[2] for x in own], fanout)))
    root, above = grown([t[1] for t in trees], fanout)
    for (own, subroot, paths), more in zip(trees, above, strict=True):
        for x, path in zip(own, paths, strict=True):
            h = x[3]
            for a, b in path + more:
                h = H(a, h, b)
            out.append((x[4], x[2], subroot, root, H(*[a + b for a, b in path + more]), h, h == root))
    return sorted(out, key=repr)


MERKLE = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def manifest_rows(df):
    return sorted((tuple(r[c] for c in MERKLE) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest_equals_brute_force(spark, docs, fanout):
    frame = docs.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("l"), F.col("doc_id").cast("string"))).when(F.col("doc_id") % 7 == 1, "é").otherwise(F.col("lang"))).withColumns({"place": F.lit(1), "h": F.lit("x"), "pos": F.lit(2)})
    got = manifest_rows(merkle.manifest(frame, fanout=fanout))
    assert got == brute_manifest(frame.collect(), fanout)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_few_rows(spark, none):
    assert merkle.manifest(none).collect() == []
    one = spark.createDataFrame([(5, "One", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    (row,) = manifest_rows(merkle.manifest(one))
    assert row[1] == row[2] == row[3] and row[4] == H()
    assert manifest_rows(merkle.manifest(one.union(one))) == brute_manifest(one.union(one).collect())


def test_manifest_finds_every_change(spark, docs):
    """Whatever field is changed in one row, that row alone is not verified."""
    base = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    for f, new in {"source": F.lit("other"), "n_chars": F.lit(-1), "text": F.concat(F.coalesce("text", F.lit("")), F.lit("!"))}.items():
        changed = {f: F.when(F.col("doc_id") == 30, new).otherwise(F.col(f))}
        bad = merkle.manifest(base, tamper=lambda _, changed=changed: changed).where("not verified").collect()
        assert [r["doc_id"] for r in bad] == [30]


# places


def test_numbered_is_gapless(spark):
    rows = [(i * 37 % 101, "x" * (i % 3)) for i in range(500)] + [(None, "n")] * 3
    df = spark.createDataFrame(rows, "k long, s string").repartition(6)
    got = numbered(df, [F.col("k").asc_nulls_first(), F.col("s")]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(503))
    assert [(r["k"], r["s"]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert numbered(df.where("false"), [F.col("k")]).collect() == []
