import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklake.llm import bits, phrases, slots, turns


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- bit filters


def test_bits_find_all_keys(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    size = bits.size_for(5000)
    packed = bits.build(keys, "key", size)
    assert size == 1 << 17 and len(packed) == size // 8
    own = np.array([r[0] for r in keys.collect()], np.int64)
    assert bits.probe(packed, own).all()
    other = np.array([r[0] for r in spark.range(9000, 19000).select(F.xxhash64("id")).collect()], np.int64)
    assert bits.probe(packed, other).mean() < 0.06
    assert not bits.probe(bits.build(keys.limit(0), "key", bits.size_for(0)), own).any()


# ---- 11: phrases


def mined(rows, least, top=2000):
    """(lang, phrase) -> (rank, a, l, r, n, score, first document), phrase by phrase."""
    f, n, doc = Counter(), Counter(), defaultdict(list)
    for i, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for j in range(len(w) - k + 1):
                    g = lang, tuple(w[j : j + k])
                    f[g] += 1
                    if i is not None:
                        doc[g].append(i)
    long = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in long.items():
        inside = any(
            b >= a and len(v) > len(w) and lang == other and any(v[i : i + len(w)] == w for i in range(len(v)))
            for (other, v), b in long.items()
        )
        if not inside:
            score, _, x, y = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.append((lang, score, a, " ".join(w), x, y, min(doc[lang, w], default=None)))
    got = []
    for lang in {o[0] for o in out}:
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))
        got += [(lang, k, p, a, x, y, n[lang], score, d) for k, (_, score, a, p, x, y, d) in enumerate(own[:top], 1)]
    return sorted(got)


def phrase_rows():
    rows = [(i, ["en", "de", None, "und", ""][i % 5], t) for i, t in cases.texts() if i not in (407, 408)]
    rows += [(900 + i, "en", "Alpha beta\tgamma  delta. epsilon alpha beta, gamma") for i in range(30)]
    rows += [(None, "en", "alpha beta gamma"), (950, "de", "a a a a a a a"), (951, "de", "x" * 40 + " " + "x" * 39 + "y a a")]
    return rows


@pytest.mark.parametrize("width", [64, 9])
def test_phrases_equal_brute_force(spark, width):
    """Nine bits make nearly all fingerprints collide; the text decides."""
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(4)
    got = phrases.collocations(cases.clashing(df), least=6, width=width)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, 6)


def test_phrases_of_little(spark):
    schema = "doc_id bigint, lang string, text string"
    assert phrases.op11(spark.createDataFrame([], schema)).collect() == []
    assert phrases.op11(spark.createDataFrame([(1, None, None), (2, "en", ""), (3, "en", "one"), (4, "en", ".,;\n")], schema)).collect() == []


def test_only_the_first_phrases_of_a_language(spark):
    rows = [(i, lang, f"w{k} v{k}") for i, (lang, k) in enumerate((x, k) for x in ("en", "fr") for k in range(9) for _ in range(3 + k % 3))]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    got = phrases.collocations(df, least=3, top=4)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, 3, 4)
    assert got.count() == 8


# ---- 12: sharding


def slot_rows():
    return [*cases.texts(), *[(None, f"text {i}") for i in range(50)], *[(7, "again")] * 9000, (None, None), (None, None)]


def dealt(sizes, shards):
    """The map that largest-first dealing gives."""
    load, out = [0] * shards, {}
    for slot, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        at = load.index(min(load)) if size else slot % shards
        out[slot] = at
        load[at] += size
    return out


def virtual(doc_id, text, block, slots_=slots.SLOTS):
    own = hashlib.md5(f"{'-' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
    return int(hashlib.md5(f"{own}:{block}".encode()).hexdigest()[:12], 16) % slots_


def test_slots_equal_brute_force(spark):
    rows = slot_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = slots.op12(cases.clashing(df)).collect()
    copies = Counter((i, t or "") for i, t in rows)
    sizes = dict.fromkeys(range(slots.SLOTS), 0)
    where = defaultdict(list)
    for (i, t), n in copies.items():
        for block in range(-(-n // slots.BLOCK)):
            own, size = min(slots.BLOCK, n - block * slots.BLOCK), len(t.encode()) + 16
            sizes[virtual(i, t, block)] += own * size
            where[i, size, zlib.crc32(t.encode())] += [virtual(i, t, block)] * own
    placing = dealt(sizes, 40)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard) for r in got) == Counter((*k, placing[s]) for k, v in where.items() for s in v)
    numbers = defaultdict(list)
    for r in got:
        numbers[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in numbers.values())
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}


def test_shards_of_bytes_are_near_equal(spark):
    rows = [(i, "x" * (i * 37 % 500)) for i in range(20_000)]
    got = slots.op12(spark.createDataFrame(rows, "doc_id bigint, text string"))
    size = [r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(size) == 40 and max(size) - min(size) < 1000


def test_slots_of_an_empty_table(spark):
    assert slots.op12(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_an_edited_map_moves_little_and_keeps_versions(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 500)) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = slots.bytes_of(slots.digests(docs)).cache()
    versions = slots.SlotMap(spark, str(tmp_path / "map"))
    one = versions.write(slots.edited(slots.empty_map(spark), held, 10), 1)
    two = versions.write(slots.edited(one, held, 11), 2)
    three = versions.write(slots.edited(two, held, 9), 3)
    maps = [dict(map(tuple, versions.read(k).collect())) for k in (1, 2, 3)]
    sizes = {r.slot: r.bytes for r in held.collect()}
    total = sum(sizes.values())
    for placing, shards in zip(maps, (10, 11, 9), strict=True):
        load = [0] * shards
        assert sorted(placing) == list(range(slots.SLOTS))
        for slot, shard in placing.items():
            load[shard] += sizes.get(slot, 0)
        assert max(load) - min(load) < 0.02 * total / shards
    moved = [sum(sizes.get(s, 0) for s in a if a[s] != b[s]) / total for a, b in zip(maps, maps[1:], strict=False)]
    assert moved[0] < 1 / 11 + 0.02 and moved[1] < 2 / 11 + 0.05
    assert three.count() == slots.SLOTS


def test_rows_are_written_by_shard(spark, tmp_path):
    docs = cases.clashing(spark.createDataFrame(cases.texts(), "doc_id bigint, text string"))
    placing = slots.edited(slots.empty_map(spark), slots.bytes_of(slots.digests(docs)), 4)
    slots.write_shards(docs, placing, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == docs.count() and got.select("shard").distinct().count() == 4
    assert got.select("row.*").columns == docs.columns


# ---- 13: conversations


def least_edits(rows):
    """The cheapest edits and, of those, the first: by uniform cost over (cost, initials)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, path, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, path
        then = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, path + "I", i, then))
        if i < len(rows):
            role, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 4, path + "D", i + 1, last))
            if not gone:
                heapq.heappush(heap, (cost + 3 + 3 * cut, path + "R", i + 1, then))
                if role == then or (role == "s" and last == ""):
                    heapq.heappush(heap, (cost + 3 * cut, path + "K", i + 1, role))


def repaired(rows):
    """conv_id -> all columns, row by row."""
    after = {}
    for conv, turn, role, text in rows:
        own = after.setdefault(conv, [])
        filled = [" " if x is None else x for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{filled[0]}:{filled[1]}".encode()) % 20
        role, text = "user" if kind == 4 else filled[2], filled[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, coded = [], []
        for k, (_, role, text) in enumerate(own):
            bare = text.strip(" \t\n\v\f\r")
            again = any(r[1:] == (role, text) for r in own[:k])
            fault = "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else ""
            faults.append(fault)
            coded.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = least_edits(coded)
        said, last, k = [], "", 0
        for e in audit:
            then = "a" if last == "u" else "u"
            name = {"a": "assistant", "u": "user"}[then]
            if e == "I":
                said.append(f"{name}:")
            elif e in "KR":
                said.append(f"{own[k][1] if e == 'K' else name}:{own[k][2]}")
            last = last if e == "D" else coded[k][0] if e == "K" else then
            k += e != "I"
        t = {r[0] for r in own if r[0] is not None}
        gaps = max(t) - min(t) + 1 - len(t) if t else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        sha = hashlib.sha256("\n".join(said).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def turn_rows():
    rng = np.random.default_rng(5)
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No!", "What?", "cut", " \n", "", None, "Fine. \t", "日本語。", "A.\x0b", "b "]
    rows = []
    for conv in range(400):
        good = conv % 2 == 0
        for turn in range(int(rng.integers(1, 9))):
            role = roles[1 + turn % 2] if good else roles[rng.choice(7, p=[0.15, 0.35, 0.35, 0.05, 0.02, 0.03, 0.05])]
            text = f"Text {turn}." if good else texts[rng.integers(len(texts))]
            rows.append((conv, None if rng.random() < 0.05 else turn + int(rng.random() < 0.1), role, text))
    rows += [(5000, t, roles[1 + t % 2] if rng.random() < 0.9 else "system", f"{t}." if t % 7 else texts[t % 11]) for t in range(330)]
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (None, None, None, None), (6000, None, "user", "x" * 50_000 + ".")]
    return rows + rows[:20]


def test_conversations_equal_brute_force(spark):
    rows = turn_rows()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    got = {r[0]: tuple(r) for r in turns.op13(cases.clashing(df)).collect()}
    want = repaired(rows)
    assert got.keys() == want.keys()
    assert [x for x in got if got[x] != want[x]] == []


def test_conversations_without_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert turns.op13(spark.createDataFrame([], schema)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = turns.op13(spark.createDataFrame([(gone, 0, "user", "Hi.")], schema)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_blocks_give_the_path_of_the_whole():
    rng = np.random.default_rng(9)
    for n in (65, 128, 200):
        rows = [(int(rng.choice([1, 2, 3, 2, 3])), bool(rng.random() < 0.1), bool(rng.random() < 0.1)) for _ in range(n)]
        rows = [(r, g, c and not g) for r, g, c in rows]
        assert turns.cheapest(rows) == least_edits([("nsua"[r], g, c) for r, g, c in rows])
    assert turns.cheapest([]) == (0, "")


def test_turns_left_are_legal(spark):
    df = spark.createDataFrame(turn_rows(), "conv_id bigint, turn bigint, role string, text string")
    said = turns.repaired(turns.damaged(df)).select(F.array_join(F.transform("made.turns", lambda t: F.substring(t["role"], 1, 1)), "").alias("s"))
    assert said.where(~F.col("s").rlike("^(s?(ua)+)?$")).count() == 0
