"""The operators' Spark-free parts against brute force."""

import io
import itertools
import math
import random
import re
import string
import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard as zstd
from hypothesis import given, settings
from hypothesis import strategies as st

from hubflow.llm import (collision_links, cube_mix, lexical_search, packing, resharding, simhash, spelling_variants, string_kernel,
                         token_files, warc)
from hubflow.llm.queries import tokenizer_path
from hubflow.llm.tokenization import encoder

PIECES = ["a", "Bc", "é", " ", "  ", "\n", "\t", "'s", "'", "²", "½", "1", "٣", "中", " ", " ", "​", "́",
          "!", "...", "—", "’", "😀", " \n", "ß", "\x1c", "\r\n", "<|endoftext|>", "ʼ", "ǆ", "word", " the"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_ids_equal_the_librarys(text):
    coder = encoder(tokenizer_path())
    assert coder.ids(text).tolist() == coder.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_librarys_on_any_text(text):
    coder = encoder(tokenizer_path())
    assert coder.ids(text).tolist() == coder.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_variable_length_round_trip(numbers):
    control, data = token_files.pack_ids(np.array(numbers, np.uint32))
    assert len(control) == -(-len(numbers) // 4)
    assert len(data) == sum(max(1, (x.bit_length() + 7) // 8) for x in numbers)
    assert token_files.unpack_ids(control, data, len(numbers)).tolist() == numbers


def test_damaged_block_is_refused():
    control, data = token_files.pack_ids(np.array([1, 70000, 3], np.uint32))
    with pytest.raises(ValueError):
        token_files.unpack_ids(control, data[:-1], 3)


def archive(records, dictionary=None, packed=True):
    out = b""
    if dictionary is not None:
        raw = dictionary.as_bytes()
        raw = zstd.ZstdCompressor().compress(raw) if packed else raw
        out += struct.pack("<II", warc.DICTIONARY_MAGIC, len(raw)) + raw
    c = zstd.ZstdCompressor(dict_data=dictionary)
    return out + b"".join(c.compress(r) for r in records)


def some_records(n=60):
    rnd = random.Random(1)
    return [warc.record(i, f"http://h/{i}", ("<p>" + " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(60))).encode(),
                        "", "response", None, "1970-01-01T00:00:00Z").replace(b"WARC-Payload-Digest: sha1:\r\n", b"") for i in range(n)]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_frames_with_leading_dictionary(packed, chunk):
    records = some_records()
    dictionary = zstd.train_dictionary(2000, records)
    data = archive(records, dictionary, packed)
    got = list(warc.frames(io.BytesIO(data), chunk))
    assert [x for _, x in got] == records
    offset, last = got[-1]
    assert zstd.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[offset:]) == last


def test_frames_without_dictionary_and_cut_off():
    records = some_records(3)
    data = archive(records)
    assert [x for _, x in warc.frames(io.BytesIO(data))] == records
    for cut in (len(data) - 1, 3):
        with pytest.raises(warc.BadRecord):
            list(warc.frames(io.BytesIO(data[:cut])))
    with pytest.raises(warc.BadRecord):
        list(warc.frames(io.BytesIO(b"GARBAGE!" + data)))
    assert list(warc.frames(io.BytesIO(b""))) == []


@pytest.mark.parametrize("damage", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
    lambda r: r.replace(b"WARC-Type: response\r\n", b""),
    lambda r: r.replace(b"WARC-Date", b"WARC-Day"),
    lambda r: r[:-1],
    lambda r: r + b"x",
    lambda r: r.replace(b"alpha", b"alphA", 1),
])
def test_bad_records_are_refused(damage):
    record = some_records(1)[0]
    fields, block = warc.parse(record)
    assert fields["warc-type"] == "response" and warc.payload_of(fields, block, 0)[0].startswith(b"<p>")
    with pytest.raises(warc.BadRecord):
        warc.parse(damage(record))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=3), st.lists(st.integers(0, 6), min_size=1, max_size=3), st.integers(0, 99))
def test_flow_is_a_cheapest_one(supply, capacity, seed):
    rnd = random.Random(seed)
    cost = [[rnd.randint(0, 5) for _ in capacity] for _ in supply]
    if sum(supply) > sum(capacity):
        with pytest.raises(ValueError):
            resharding.min_cost_flow(supply, capacity, cost)
        return
    flow = resharding.min_cost_flow(supply, capacity, cost)
    assert [sum(r) for r in flow] == supply and all(sum(c) <= k for c, k in zip(zip(*flow), capacity))
    best = {tuple(capacity): 0}  # cheapest by room left, unit by unit
    for i, n in enumerate(supply):
        for _ in range(n):
            step = {}
            for room, c in best.items():
                for j, r in enumerate(room):
                    if r:
                        key = (*room[:j], r - 1, *room[j + 1:])
                        step[key] = min(step.get(key, 1 << 30), c + cost[i][j])
            best = step
    assert sum(f * c for fr, cr in zip(flow, cost) for f, c in zip(fr, cr)) == min(best.values())


def fewest(sizes, capacity):
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[k] <= capacity:
                place(k + 1, [*bins[:j], bins[j] + sizes[k], *bins[j + 1:]])
        place(k + 1, [*bins, sizes[k]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_packing_is_optimal_on_small_cases(sizes):
    histogram = {s: sizes.count(s) for s in set(sizes)}
    plan = packing.plan_packing(histogram, 20)
    used = {}
    for filling, times in plan:
        assert sum(filling) <= 20 and times > 0
        for s in filling:
            used[s] = used.get(s, 0) + times
    assert used == histogram
    n = sum(t for _, t in plan)
    count = np.bincount(sizes, minlength=21)
    best = fewest(sorted(sizes, reverse=True), 20)
    assert packing.lower_bound(count, 20) <= best <= n <= best + (len(sizes) > 7)


def test_packing_large_histograms():
    rnd = random.Random(3)
    histogram = {s: rnd.randint(0, 40) for s in range(1, 1025)}
    plan = packing.plan_packing(histogram, 1024)
    n, words = sum(t for _, t in plan), sum(s * c for s, c in histogram.items())
    assert n * 1024 - words < 0.01 * words
    assert packing.plan_packing({}, 1024) == []


def slow_fingerprint(text, k):
    import re
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash.LOWER))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBÉ \t\n\x0b z", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == slow_fingerprint(text, 3)
    assert simhash.fingerprint(None) == 0


def test_pigeonhole_shares_find_every_link():
    rnd = np.random.default_rng(5)
    center = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = list(center)
    for c in center:
        for _ in range(25):
            flips = rnd.choice(64, rnd.integers(0, 5), replace=False)
            fps.append(np.uint64(int(c) ^ sum(1 << int(b) for b in flips)))
    fps = np.unique(np.array(fps, np.uint64))
    for parts in (1, 2, 3):
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
        groups = simhash.group_bits(bits.T @ bits, len(fps), parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        tables = {}
        for g, of in enumerate(groups):
            for s, piece in enumerate(simhash._pieces(of)):
                share = np.bincount(simhash._pick(fps, piece).astype(int), minlength=1 << len(piece)) / len(fps)
                tables[g, s] = simhash.near_shares(share, len(piece), 2)
                assert np.allclose(tables[g, s][0], share)
        shares = simhash.shares_of(fps, groups, tables, len(fps), 2)
        assert (shares.astype(int) + 1 >= 0).all() and ((shares + 1).sum(axis=1) == 3).all()
        values = [simhash._pick(fps, g) for g in groups]
        near = np.bitwise_count(fps[:, None] ^ fps[None, :])
        found = np.zeros(near.shape, bool)
        for g in range(parts):
            found |= np.bitwise_count(values[g][:, None] ^ values[g][None, :]) <= shares[:, g][:, None]
        assert found[near <= 2].all()


def test_near_shares_by_counting():
    share = np.random.default_rng(1).random(32)
    got = simhash.near_shares(share, 5, 2)
    v = np.arange(32)
    away = np.bitwise_count((v[:, None] ^ v[None, :]).astype(np.uint64))
    for d in range(3):
        assert np.allclose(got[d], [(share[away[x] == d]).sum() for x in v])


def test_collision_counts_and_calibration():
    rnd = np.random.default_rng(2)
    q, c = rnd.standard_normal((20, 6)), rnd.standard_normal((33, 6))
    want = (np.abs(q[:, None, :] - c[None, :, :]) <= 0.4).sum(axis=2)
    assert (collision_links.collisions(q, c, 0.4) == want).all()
    half, need = collision_links.calibrate(0.93, 32, 0.99999)
    x = rnd.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rnd.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    at = collision_links.directions(64, 32)
    assert ((np.abs(x @ at - y @ at) <= half).sum(axis=1) >= need).mean() >= 0.999


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=40))
def test_grams(text):
    raw = text.lower().encode("utf-8", "replace")
    want = set()
    shift = 0
    for n in string_kernel.ORDERS:
        want |= {shift + int.from_bytes(raw[i:i + n], "big") for i in range(len(raw) - n + 1)}
        shift += 256**n
    got = string_kernel.grams(text)
    assert len(got) == len(set(got.tolist())) and set(got.tolist()) == want


def test_kernel_regression_tells_languages():
    rnd = random.Random(7)
    words = {"xx": ["alan", "berto", "casa", "donde"], "yy": ["strasse", "zwischen", "haus", "und"]}
    make = lambda lang, n: " ".join(rnd.choice(words[lang]) for _ in range(n))
    langs = ["xx", "yy"] * 30
    model = string_kernel.fit([make(x, 12) for x in langs], langs, landmarks_per_lang=8)
    test = ["xx", "yy"] * 40
    got, familiar = model.responses([make(x, 5) for x in test])
    assert [model.langs[k] for k in got.argmax(axis=1)] == test and familiar.min() > 0.5
    assert model.responses([""])[0].shape == (1, 2) and model.responses(["0123456789"])[1][0] < 0.25


def test_kernel_and_ridge_equal_the_formulas(monkeypatch):
    """Presence kernel, K(L, L)^(-1/2), ridge weights and responses, written out with sets and dense matrices."""
    rnd = random.Random(11)
    langs = [rnd.choice(["a", "b", "c"]) for _ in range(30)]
    texts = ["".join(rnd.choice({"a": "abcde", "b": "cdefg é", "c": "fgha "}[x]) for _ in range(rnd.randrange(3, 60))) for x in langs]
    sets = lambda t: {(n, t.lower().encode()[i:i + n]) for n in string_kernel.ORDERS for i in range(len(t.lower().encode()) - n + 1)}
    kern = lambda x, y: len(sets(x) & sets(y)) / np.sqrt(len(sets(x)) * len(sets(y)))
    names = sorted(set(langs))
    marks = [i for name in names for i in [i for i, x in enumerate(langs) if x == name][:4]]
    k = np.array([[kern(t, texts[m]) for m in marks] for t in texts])
    values, vectors = np.linalg.eigh(k[marks])
    half = vectors @ np.diag(np.where(values > 1e-6 * values.max(), 1 / np.sqrt(np.maximum(values, 1e-12)), 0)) @ vectors.T
    z = k @ half
    y = np.array([[float(x == name) for name in names] for x in langs])
    w = np.linalg.solve(z.T @ z + string_kernel.RIDGE * len(texts) * np.eye(len(marks)), z.T @ y)
    new = ["abcab", "fgfg", "edé g", "zzz", ""]
    want = np.array([[kern(t, texts[m]) if t else 0.0 for m in marks] for t in new]) @ half @ w
    for block in (string_kernel.BLOCK_BYTES, 4096):  # one dense block, several blocks
        monkeypatch.setattr(string_kernel, "BLOCK_BYTES", block)
        model = string_kernel.fit(texts, langs, landmarks_per_lang=4)
        assert np.allclose(model.kernel(texts)[0], k, atol=1e-6)
        assert np.allclose(model.responses(new)[0], want, atol=1e-4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 30), st.integers(1, 9)), max_size=120), st.lists(st.integers(0, 13), max_size=8, unique=True),
       st.integers(1, 6), st.sampled_from([0.0, 0.2, 0.6, 1.0]), st.sampled_from([3, 1024]))
def test_search_of_a_shard_equals_full_scoring(postings, terms, k, short, block):
    """Any split into short and long lists and any block give the k best of all documents, ties by doc_id (none last)."""
    cells = {(t, d): i for t, d, i in postings}
    rows = sorted(cells, key=lambda c: random.Random(str(c)).random())
    doc = np.array([100 + d for _, d in rows], np.int64)
    ids = np.array([d * 7 % 31 for _, d in rows], np.int64)
    nameless = np.array([d % 11 == 5 for _, d in rows], bool)
    ids[nameless] = 0
    shard = lexical_search.Shard(doc, ids, nameless, np.array([t for t, _ in rows], np.int64), np.array([cells[c] for c in rows], np.int64))
    weights = [t % 4 for t in terms]
    found, scores = shard.search(terms, weights, k, short, block)
    total = {}
    for (t, d), i in cells.items():
        if t in terms:
            total[d] = total.get(d, 0) + i * (t % 4)
    best = sorted(((-s, d % 11 == 5, 0 if d % 11 == 5 else d * 7 % 31, 100 + d) for d, s in total.items() if s > 0))[:k]
    assert [(-int(s), int(doc[r])) for r, s in zip(shard.row[found], scores)] == [(b[0], b[3]) for b in best]


def test_typos_and_counts():
    text = "Éclair éclairs ABCdef " * 3 + "x" * 5
    got = spelling_variants.runs_of(3, text)
    want = {}
    for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if c in string.ascii_uppercase else c for c in text)):
        h = zlib.crc32(f"3:{run}".encode())
        run = run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]
        if len(run) >= 6:
            want[run] = want.get(run, 0) + 1
    assert got == want and spelling_variants.runs_of(None, None) == {}
    hit = next(w for w in map("letters{}".format, map("".join, itertools.product("abcdefgh", repeat=3))) if zlib.crc32(f"9:{w}".encode()) % 199 == 0)
    h = zlib.crc32(f"9:{hit}".encode())
    assert spelling_variants.runs_of(9, hit) == {hit[:h % len(hit)] + hit[h % len(hit) + 1:]: 1}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 2000)), max_size=60))
def test_cube_keeps_both_totals(units):
    chance, size = [p for p, _ in units], [float(s) for _, s in units]
    out = cube_mix.flight(chance, size, list(range(len(units))), 42, 0)
    undecided = [p for p in out if 0 < p < 1]
    assert len(undecided) <= 2 and all(0 <= p <= 1 for p in out)
    assert abs(sum(out) - sum(chance)) < 1e-4
    assert abs(sum(p * s for p, s in zip(out, size)) - sum(p * s for p, s in zip(chance, size))) < 1e-2
    assert out == cube_mix.flight(chance, size, list(range(len(units))), 42, 0)
    landed = cube_mix.landing(out, size)
    assert set(landed) <= {0.0, 1.0}
    if size:
        assert abs(sum(p * s for p, s in zip(landed, size)) - sum(p * s for p, s in zip(out, size))) <= max(size)


def test_cube_inclusion_follows_the_chances():
    taken = np.zeros(6)
    size = [10.0, 20.0, 30.0, 5.0, 25.0, 15.0]
    chance = [0.5, 0.25, 0.75, 0.5, 0.5, 0.5]
    runs = 3000
    for seed in range(runs):
        out = cube_mix.flight(chance, size, list(range(6)), seed, 0)
        taken += out
    assert np.abs(taken / runs - chance).max() < 0.04


def reshared(sizes, weights, repeats):
    target, open_, left = {}, list(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        stopped = [i for i in open_ if unit * weights[i] > repeats * sizes[i]]
        if not stopped:
            return target | {i: unit * weights[i] for i in open_}
        for i in stopped:
            target[i] = float(repeats * sizes[i])
            left -= target[i]
            open_.remove(i)
    return target


def test_targets_by_resharing(spark):
    rnd = random.Random(11)
    for case in range(4):
        sizes = [rnd.choice([0, 1, 5, 50, 1000, 20000]) for _ in range(8)] + [3]
        rows = [(f"s{i:02d}", n) for i, n in enumerate(sizes[:-1])] + [(None, sizes[-1])]
        df = spark.createDataFrame(rows, "source string, source_size long")
        got = {r["source"]: r["target"] for r in cube_mix.source_targets(df).collect()}
        want = reshared(sizes, [1 + i % 3 for i in range(9)], 3)
        for i, (s, _) in enumerate(rows):
            assert got[s] == pytest.approx(want[i], rel=1e-9, abs=1e-6)


def test_blocks_even_out_within_the_smallest_block():
    rnd = random.Random(2)
    blocks = [(i % 3, i, rnd.randint(1, 400)) for i in range(300)]
    supply = [sum(s for j, _, s in blocks if j == i) for i in range(3)]
    total = sum(supply)
    capacity = [total // 5 + (j < total % 5) for j in range(5)]
    flow = resharding.min_cost_flow(supply, capacity, [[int(i != j) for j in range(5)] for i in range(3)])
    new = resharding.place_blocks(blocks, flow, capacity)
    load = [sum(b[2] for b, n in zip(blocks, new) if n == j) for j in range(5)]
    assert max(load) - min(load) <= 20
    moved = sum(b[2] for b, n in zip(blocks, new) if n != b[0])
    assert moved <= sum(f for i, r in enumerate(flow) for j, f in enumerate(r) if i != j) + 5 * 400


def test_all_fillings_dominate():
    for sizes in itertools.combinations(range(2, 12), 4):
        count = np.bincount(sizes, minlength=13)
        got = packing.completions(count, 12, most=50)
        best = max(sum(c) for k in range(5) for c in itertools.combinations(sizes, k) if sum(c) <= 12)
        assert sum(got[0]) == best
