"""Each operator against a plain version, with nulls, empty and long texts, ties and repeats."""

import hashlib
import io
import itertools
import re
import struct
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from quillboard.llm import bpe, embedding, jaccard, license, media, mixing, quality, suffixdedup, tokenfile, unigram  # noqa: E402
from quillboard.llm._graph import connected_components  # noqa: E402
from quillboard.llm._scratch import Scratch  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, slot string"
WORDS = "ash bee cat dog elm fox gnu hen ivy jay kid law map nut oak pig rat sea tea urn".split()


def prose(seed, n=80):
    r = np.random.default_rng(seed)
    return " ".join(WORDS[k] for k in r.integers(0, len(WORDS), n))


PASSAGE = prose(1)
TEXTS = [None, "", "  \n", "one", "Two words", PASSAGE, PASSAGE, PASSAGE.upper(), prose(2) + " " + PASSAGE, PASSAGE + " " + prose(3), PASSAGE + " tail", "ab" * 300, prose(4, 9000), "Released under the MIT License.\nCC BY cc by", "ünï <|endoftext|> ' x\u001cΣΣ", "x" * 70000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 3 else None, f"s{k % 3}" if k % 5 else None, len(t) if t else None, "clash", "clash") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[5], (None, PASSAGE, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_media(docs, none):
    rows = media.media_digest(docs).collect()
    assert len(rows) == len(TEXTS) + 2 and media.media_digest(none).count() == 0
    for r in rows:
        raw = (PASSAGE if r["doc_id"] is None else TEXTS[r["doc_id"]] or "").encode()
        padded = raw + b" " * (-len(raw) % 192 or (0 if raw else 192))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
        assert r["media_bytes"] == len(padded) + 44 and r["feature"].startswith("audio/wav;")


def test_sniff(spark):
    import gzip
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.txt", "hello")
    zipped, wav, gz = z.getvalue(), media.to_wav(b"abc" * 64), gzip.compress(b"hello" * 50)
    assert media.sniff(zipped)[:2] == ("application/zip", len(zipped))
    assert media.sniff(gz + b"rest")[:2] == ("application/gzip", len(gz))
    assert media.sniff(b"text RIFF and BM without structure")[0] == "application/octet-stream"
    carved = media.sniff(b"junk" + wav + b"more" + gz)[2]
    assert [(s, n, k) for s, n, k in carved] == [(4, len(wav), "audio/wav"), (8 + len(wav), len(gz), "application/gzip")]
    df = spark.createDataFrame([(bytearray(wav), "text/plain"), (None, None)], "data binary, declared string")
    got = media.sniff_media(df, "data", "declared").collect()
    assert [(r["detected_type"], r["corrected"]) for r in got] == [("audio/wav", True), ("application/octet-stream", False)]


def test_ends_of_pdf():
    part = b"%PDF-1.4\n1 0 obj\nendobj\nstartxref\n9\n%%EOF"
    added = part + b"\n2 0 obj\nendobj\nstartxref\n50\n%%EOF"
    within = b"%PDF-1.7\nstream\n" + part + b"\nendstream\nstartxref\n9\n%%EOF"
    for whole in (part, added, within):
        assert media.sniff(whole)[:2] == ("application/pdf", len(whole)) == media.sniff(whole + b" rest %%EOF")[:2]
        assert [(s, n) for s, n, _ in media.locate(b"x" + whole + b"--" + added)] == [(1, len(whole)), (3 + len(whole), len(added))]
    assert media.sniff(b"%PDF-1.4 no end %%EOF")[0] == "application/octet-stream"


def flac(frames, total, body=b""):
    """A stream with a checksum on each frame; samples are not coded, which no validator looks at."""

    def crc(data, bits, polynomial):
        x = 0
        for c in data:
            x ^= c << (bits - 8)
            for _ in range(8):
                x = (x << 1 ^ polynomial if x >> (bits - 1) & 1 else x << 1) & ((1 << bits) - 1)
        return x.to_bytes(bits // 8, "big")

    info = struct.pack(">HH", 4096, 4096) + b"\0" * 6 + (44100 << 44 | 1 << 41 | 15 << 36 | total).to_bytes(8, "big") + b"\0" * 16
    out = b"fLaC\x80" + len(info).to_bytes(3, "big") + info
    for k in range(frames):
        head = b"\xff\xf8\xc9\x18" + chr(k).encode()
        frame = head + crc(head, 8, 0x07) + np.random.default_rng(k).bytes(60) + body
        out += frame + crc(frame, 16, 0x8005)
    return out


@pytest.mark.parametrize("total", [3 * 4096, 3 * 4096 - 100, 0])
def test_ends_of_flac(total):
    whole = flac(3, total, b"\xff\xf8\xc9\x18")
    assert media.sniff(whole)[:2] == ("audio/flac", len(whole))
    wav = media.to_wav(b"abc" * 64)
    assert [(s, n, k) for s, n, k in media.locate(b"junk" + whole + wav)] == [(4, len(whole), "audio/flac"), (4 + len(whole), len(wav), "audio/wav")]
    assert media.sniff(whole[:-5])[0] == ("application/octet-stream" if total else "audio/flac") or total == 0
    assert media.sniff(flac(140, 140 * 4096))[1] == len(flac(140, 140 * 4096))  # numbers of two bytes


def shingles(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in sets}


def test_jaccard(spark, docs, none):
    sets = {k: shingles(t) for k, t in enumerate(TEXTS)}
    rows = jaccard.shingle_join(docs, Scratch(spark, "t")).collect()
    assert len(rows) == len(TEXTS) + 2
    want = components(sets)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows} == {(k, len(s), want[k]) for k, s in sets.items()} | {(None, len(sets[5]), None)}
    assert jaccard.shingle_join(none, Scratch(spark, "t")).count() == 0


def test_jaccard_of_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    r, base, texts = np.random.default_rng(5), prose(9, 160).split(), []
    for k in range(60):
        w = list(base)
        for at in r.integers(0, len(w), int(r.integers(0, 9))):
            w[at] = f"w{r.integers(0, 1000)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = components({k: shingles(t) for k, t in enumerate(texts)})
    assert {x["doc_id"]: x["component_id"] for x in jaccard.shingle_join(df, Scratch(spark, "t")).collect()} == want


def removed(texts):
    seen, out = set(), {}
    for k, t in enumerate(texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(b[s : s + 100])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[k] = (len(b), int(gone.sum()), int(gone[:1].sum() + np.count_nonzero(gone[1:] & ~gone[:-1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("hot", "local"), [(20_000, 512), (1, 512), (20_000, 1), (3, 2)])
def test_suffix_dedup(spark, docs, none, monkeypatch, hot, local):
    monkeypatch.setattr(suffixdedup, "HOT", hot)
    monkeypatch.setattr(suffixdedup, "LOCAL", local)
    rows = suffixdedup.remove_repeats(docs, Scratch(spark, "t")).collect()
    assert len(rows) == len(TEXTS) + 2
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert {k: v for k, v in got.items() if k is not None} == removed(TEXTS)
    assert got[None][1] == 0 and suffixdedup.remove_repeats(none, Scratch(spark, "t")).count() == 0
    left = by_id(suffixdedup.remove_repeats(docs, Scratch(spark, "t"), keep=True))
    assert left[5]["text"] == PASSAGE and left[6]["text"] == "" and left[0]["text"] is None and left[5]["slot"] == "clash"


def cut_texts(texts):
    """What is left of each text without the characters that lose a byte to a string of 100 bytes which also starts earlier."""
    seen, out = set(), []
    for t in texts:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        at, left = 0, []
        for c in t or "":
            size = len(c.encode())
            left += [c] * (not any(gone[at : at + size]))
            at += size
        out.append(None if t is None else "".join(left))
    return out


def test_cuts_take_whole_characters(spark):
    """The ends of a repeat may fall inside characters; no new one may come of what is left."""
    r = np.random.default_rng(12)
    letters = [chr(c) for c in (*range(0x160, 0x180), *range(0xC0, 0xE0), 0x4E2D, 0x6587, 0x1F600, 0x61, 0x62, 0x20)]
    draw = lambda n: "".join(r.choice(letters, n))
    shared = [draw(90) for _ in range(6)]
    texts = [draw(int(r.integers(0, 40))) + shared[k % 6][int(r.integers(0, 20)) : int(r.integers(60, 90))] + draw(int(r.integers(0, 40))) for k in range(120)]
    # the same bytes in other characters: the middle of one letter's bytes and the next one's first
    tail = "\u017a" * 60
    texts += ["a\u0164" + tail + "\u00c3z", "b\u0144" + tail + "\u0103z", None, "", "\u017a" * 49, "\u017a" * 50, "\u017a" * 51]
    got = suffixdedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), Scratch(spark, "t"), keep=True).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])] == cut_texts(texts)


def test_suffix_dedup_of_many_rows_without_id(spark):
    rows = [(None, PASSAGE)] * 40 + [(None, prose(k)) for k in range(40)] + [(1, PASSAGE), (1, PASSAGE), (1, prose(99) + PASSAGE), (2, None)]
    got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()
    assert len(got) == 84 and all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert sum(r["n_removed"] > 0 for r in got if r["doc_id"] == 1) in (1, 2)


def test_suffix_dedup_of_shared_passages(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "LOCAL", 3)
    r, passage = np.random.default_rng(8), prose(21, 60)
    texts = [prose(100 + k, int(r.integers(0, 30))) + " " + passage[int(r.integers(0, 60)) : int(r.integers(150, len(passage)))] + " " + prose(300 + k, 20) for k in range(80)] + [passage] * 30
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    rows = suffixdedup.remove_repeats(d, Scratch(spark, "t")).collect()
    assert {x["doc_id"]: tuple(x)[1:] for x in rows} == removed(texts)


def test_suffix_dedup_with_colliding_hashes(spark, monkeypatch):
    """Contexts that collide in all 64 bits of their hash are kept apart by their bytes."""
    plain = suffixdedup.anchors

    def collide(data, offsets):
        row, pos, gram, context, lo, hi = plain(data, offsets)
        return row, pos, gram, context & np.uint64(3), lo, hi

    monkeypatch.setattr(suffixdedup, "anchors", collide)
    texts = [prose(k, 60) for k in range(6)] + [prose(2, 60)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    row, pos, gram, context, lo, hi = suffixdedup.anchors(data, offsets)
    again = [b for b in suffixdedup._deal([(gram, context, row, np.zeros(len(row), np.int64), pos, lo, hi)], [data], 0, 0) if b.column("bucket")[0].as_py() < 0]
    docs = np.concatenate([np.frombuffer(x, np.uint32) for b in again for x in b.column("doc").to_pylist()]) if again else np.empty(0)
    assert set(docs.tolist()) <= {6}


def test_clashing_names(spark, docs):
    clash = docs.select("*", *(docs["slot"].alias(c) for c in ("tag", "marks", "row", "component_id", "key", "text_score")))
    left = suffixdedup.remove_repeats(clash, Scratch(spark, "t"), keep=True)
    assert left.columns == clash.columns and all(r["tag"] == r["marks"] == r["slot"] for r in left.collect())
    assert jaccard.shingle_join(clash, Scratch(spark, "t")).count() == clash.count()
    assert license.license_scan(clash).count() == bpe.bpe_digest(clash, public_tokenizers.path("word_bpe_49k.json")).count() == clash.count()


def test_jaccard_in_parts(spark, monkeypatch):
    """Many parts of each bucket, and codes that are hot in some of them only."""
    monkeypatch.setattr(jaccard, "SPLIT", 8)
    monkeypatch.setattr(jaccard, "HOT", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    r, base, texts = np.random.default_rng(6), prose(19, 160).split(), []
    for k in range(90):
        w = list(base) if k % 3 else prose(700 + k // 9, 140).split()
        for at in r.integers(0, len(w), int(r.integers(0, 7))):
            w[at] = f"w{r.integers(0, 1000)}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = components({k: shingles(t) for k, t in enumerate(texts)})
    assert {x["doc_id"]: x["component_id"] for x in jaccard.shingle_join(df, Scratch(spark, "t")).collect()} == want


def test_jaccard_of_an_id_with_two_texts(spark):
    a, b = prose(31, 60), prose(32, 60)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, prose(33, 60)), (9, b), (9, prose(34, 60)), (8, prose(34, 60) + " end")]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.shingle_join(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark, "t")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (9, 1), (8, 1)}


def test_embedding_of_several_dimensions_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 40)
    monkeypatch.setattr(embedding, "CELL", 16)
    r = np.random.default_rng(4)
    rows, k = [], 0
    for width, n in ((16, 500), (8, 120), (3, 40), (1, 4)):
        x = r.normal(size=(n, width))
        x[: n // 3] = x[0] + r.normal(size=(n // 3, width)) * 0.03  # a third of all rows are one group
        x[n // 3 : n // 2] = x[n // 3 - 1] * 2
        for v in x:
            rows.append((k, "ab"[k % 7 == 0], v.tolist()))
            k += 1
    want_links, parent = dict.fromkeys(range(k), 0), list(range(k))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a, u) in enumerate(rows):
        for j in range(i):
            _, b, v = rows[j]
            if a == b and len(u) == len(v) and np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                want_links[i] += 1
                want_links[j] += 1
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    got = {x["vec_id"]: x for x in embedding.near_vectors(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>"), Scratch(spark, "t")).collect()}
    assert {i: g["n_links"] for i, g in got.items()} == want_links
    assert {i: g["component_id"] for i, g in got.items()} == {i: find(i) for i in range(k)}
    assert all(g["kept"] == (find(i) == i) for i, g in got.items())


def test_embedding(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 16))
    x[100:200] = x[0] + r.normal(size=(100, 16)) * 0.1
    x[200:210] = x[5]
    x[210] = 0
    rows = [(k, k % 2 if k != 50 else None, [float(np.float32(c)) for c in v]) for k, v in enumerate(x)] + [(300, 0, None), (301, 0, [1.0, None]), (302, 0, [float("nan")] * 16), (None, 0, [1.0] * 16), (5, 1, [float(np.float32(c)) for c in x[5]])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = embedding.near_vectors(df, Scratch(spark, "t")).collect()
    assert len(got) == len(rows)
    v = np.array([row[2] for row in rows[:210]] + [rows[-1][2]], np.float64)
    ids, labels = [*range(210), 5], [row[1] for row in rows[:210]] + [1]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    same = np.array([[a == b and a is not None for b in labels] for a in labels])
    links = ((u @ u.T >= 0.98) & same).sum(1) - np.array([lab is not None for lab in labels])
    by = {r["vec_id"]: r["n_links"] for r in got if r["vec_id"] is not None}
    assert {i: by[i] for i in ids} == dict(zip(ids, links.tolist(), strict=True))
    assert all(r["n_links"] == 0 for r in got if r["vec_id"] in (None, 50, 210, 300, 301, 302))
    assert embedding.near_vectors(df.where("false"), Scratch(spark, "t")).count() == 0


def test_token_files(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, scratch = Tokenizer.from_file(path), Scratch(spark, "t")
    manifest = tokenfile.write_token_files(docs, path, f"{scratch.path}/ids", 2, scratch, shard_bytes=4000)
    rows = sorted(tokenfile.read_token_files(manifest).collect(), key=lambda r: r["start"])
    order = [(None, PASSAGE), *sorted([*enumerate(TEXTS), (5, PASSAGE)], key=lambda x: x[0])]
    start = 0
    assert manifest.count() > 2 and len(rows) == len(order)
    for r, (k, t) in zip(rows, order, strict=True):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for path in [r["path"] for r in manifest.collect()]:
        with tokenfile._open(path, "r") as f:
            shard = tokenfile.Shard(f)
            known = [(k, x.tolist()) for k, _, x in shard.scan() if k is not None]
            assert all(shard.get(k).tolist() == next(x for j, x in known if j == k) for k, _ in known)
            assert shard.get(10**12) is None
            wanted = np.array([*(k for k, _ in known), 10**12], np.int64)
            assert (shard.lookup(wanted)[:-1] >= 0).all() and shard.lookup(wanted)[-1] == -1
    wanted = spark.createDataFrame([(3,), (7,), (12,), (7,), (10**12,), (None,)], "doc_id long")
    got = {r["doc_id"]: r["ids"] for r in tokenfile.lookup_token_files(manifest, wanted).collect()}
    assert got == {k: [*library.encode(TEXTS[k] or "", add_special_tokens=False).ids, 2] for k in (3, 7, 12)}
    empty = Scratch(spark, "t")
    assert tokenfile.read_token_files(tokenfile.write_token_files(none, public_tokenizers.path("byte_bpe_50k.json"), f"{empty.path}/ids", 2, empty)).count() == 0


def test_lookup_of_shared_keys(spark):
    rows = [(1, "a"), (5, "one"), (5, "two words"), (5, ""), (9, "z"), (9, "z"), (None, "none")]
    for size in (1 << 20, 4):  # in one file, and in several
        scratch = Scratch(spark, "t")
        manifest = tokenfile.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json"), f"{scratch.path}/ids", 2, scratch, shard_bytes=size)
        got = tokenfile.lookup_token_files(manifest, spark.createDataFrame([(5,), (9,), (4,)], "doc_id long")).collect()
        assert sorted(r["doc_id"] for r in got) == [5, 5, 5, 9, 9]
        assert len({tuple(r["ids"]) for r in got if r["doc_id"] == 5}) == 3


def test_a_wrong_index_is_an_error():
    packed = bytearray(tokenfile.pack([1, 2, 3], [np.array([k], "<u2") for k in range(3)], 2))
    packed[tokenfile.HEADER.size + 4] ^= 255  # a fingerprint
    with pytest.raises(ValueError):
        list(tokenfile.Shard(io.BytesIO(bytes(packed))).scan())


def random_texts(n, seed):
    r = np.random.default_rng(seed)
    plain = [*map(chr, range(0x21, 0x7F)), *map(chr, range(0xA0, 0x250)), *" " * 200, *"\n" * 30]
    odd = list("''\u2019\u0301\u0307\u0130\u03a3\u03c3\u03c2\u1c89\ua7cb\ua7da\U00010d50\u65e5\u0e01\u212a\u3000\x1c\x85\t\r")
    for _ in range(n):
        yield "".join(r.choice(odd) if r.random() < 0.15 else plain[r.integers(len(plain))] for _ in range(int(r.integers(1, 40))))


def test_encoders_on_random_letters():
    """Letters of every plane that is at risk: those that newer Unicode versions case or compose."""
    from tokenizers import Tokenizer

    words, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
    by_word, by_byte, library, other = bpe.WordCodec(words), tokenfile.Encoder(pieces), Tokenizer.from_file(words), Tokenizer.from_file(pieces)
    library.no_truncation()
    library.no_padding()
    for t in random_texts(4000, 11):
        assert np.frombuffer(by_word.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t)
        assert by_byte.encode([t])[0].tolist() == other.encode(t, add_special_tokens=False).ids, ascii(t)


def test_pieces_of_a_batch():
    """Texts are cut together, and each has the library's ids whatever stands beside it."""
    from tokenizers import Tokenizer

    pieces = lambda t: [t.encode()[a:b].decode() for a, b in itertools.pairwise([*tokenfile.cut(t.encode(), np.array([0, len(t.encode())])).tolist(), len(t.encode())])]
    assert pieces("\nDon't  go,\u00e9t\u00e9! a\u00d7b\n\n x9\n") == ["\n", "Don", "'t", "  go", ",\u00e9t\u00e9", "!", " a\u00d7b", "\n\n x", "9", "\n"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), tokenfile.Encoder(path)
    texts = ["", *random_texts(3000, 17), "", "\n", "it's", "'s,''s", "a\u00d7b \u00f7c", "x<|endoftext|>y", ""]
    for t, got in zip(texts, encoder.encode(texts), strict=True):
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids, ascii(t)


def test_very_long_words(monkeypatch):
    from tokenizers import Tokenizer, models, pre_tokenizers

    word = "".join(np.random.default_rng(3).choice(["qu", "x", "the", "zz", "ing"], 20_000))
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    codec = bpe.WordCodec(path)
    assert np.frombuffer(codec.encode(word), "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
    assert not codec.word_ids and not codec.run_ids  # not kept
    monkeypatch.setattr(bpe, "LONG", 50)
    monkeypatch.setattr(unigram, "LONG", 50)
    assert np.frombuffer(bpe.WordCodec(path).encode(word[:3000]), "<u4").tolist() == library.encode(word[:3000], add_special_tokens=False).ids
    pieces = unigram.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = Tokenizer(models.Unigram(pieces, 0, True))
    model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
    counter = unigram.Counter(pieces)
    for text in (word[:3000], "\u65e5" * 130, "x" * 49, "x" * 50):
        assert counter.count(text)[0] == len(model.encode(text, add_special_tokens=False).ids)


def test_caches_are_bounded_in_bytes():
    runs = bpe._Runs(lambda r: r.encode() * 100, 10**9, 10_000)
    for k in range(1000):
        assert runs[f"w{k}"] == f"w{k}".encode() * 100
    assert len(runs) < 40


def test_marks_are_searched_once():
    import time

    began = time.time()
    assert media.sniff(b"%PDF-" * 400_000)[0] == "application/octet-stream"
    assert media.sniff(b"PK\x03\x04PK\x05\x06" * 100_000)[0] == "application/octet-stream"
    assert time.time() - began < 20
    zipped = b"PK\x03\x04" + struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0, 0, 0, 4, 500)
    assert media.sniff(zipped)[0] == "application/octet-stream"  # its comment isn't there
    assert media.sniff(zipped + b"c" * 500)[:2] == ("application/zip", len(zipped) + 500)


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_perfect_hash(n):
    keys = np.arange(n, dtype=np.int64) * 977 - 5
    assert sorted(tokenfile.build_index(keys)[1].tolist()) == list(range(n))


def test_quality(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = labels.where("doc_id % 3 = 0")
    scores = quality.quality_scores(d, labels.where("doc_id % 3 <> 0"), Scratch(spark, "t"))
    right = scores.join(held_out, "doc_id").selectExpr("avg(cast(accepted = (quality = 1) as int))").first()[0]
    assert right >= 0.95 and scores.count() == d.count()
    for view in ("text_score", "meta_score"):
        alone = scores.join(held_out, "doc_id").selectExpr(f"avg(cast(({view} >= 0.5) = (quality = 1) as int))").first()[0]
        assert alone >= (0.9 if view == "text_score" else 0.5)


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    score = lambda d, of, **more: quality.quality_scores(d, of, Scratch(spark, "t"), **more)
    assert all(r["accepted"] for r in score(docs, labels).collect())
    some = spark.createDataFrame([(k, k % 2, 0) for k in range(12)], "doc_id long, quality int, toxic int")
    rows = score(docs, some).collect()
    assert len(rows) == len(TEXTS) + 2 and score(none, some).count() == 0
    kept = score(docs, some, keep=True)
    assert kept.columns == docs.columns and kept.count() == sum(r["accepted"] for r in rows)


def test_grams_count_words(spark):
    import pyarrow as pa

    texts = ["Ash bee ash", None, "", "ash bee " * 40_000, "bee"]
    got = quality.gram_view(pa.array(texts))
    assert got.shape == (5, 1 << quality.GRAM_BITS) and not got[1].any() and not got[2].any()
    shares = (got[0].astype(float) / 255) ** 2
    assert abs(shares.sum() - 1) < 0.02 and np.isclose(np.sort(shares)[-1], 2 / 5, atol=0.01)  # ash twice of five grams
    assert np.isclose(got[4].max(), 255)


def schedule(parts, slots):
    """Earliest deadline first among released blocks, one slot at a time."""
    period, done, out = sum(parts.values()), dict.fromkeys(parts, 0), []
    for t in range(slots):
        due = [(-(-(done[s] + 1) * period // w), s) for s, w in sorted(parts.items()) if done[s] * period // w <= t]
        s = min(due)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out


def test_mixing(spark, docs, none):
    parts = {"": 1, "s0": 2, "s1": 3, "s2": 4}
    got = mixing.mix_sources(docs, parts, block_docs=1).collect()
    assert len(got) == len(TEXTS) + 2 and all(r["release"] <= r["slot"] < r["deadline"] for r in got)
    assert len({r["slot"] for r in got}) == len(got) and mixing.mix_sources(none).count() == 0
    laid = schedule(parts, 200)
    assert all(laid[r["slot"]] == (r["source"] or "", r["block"]) for r in got)
    clash = docs.select("*", *(docs["slot"].alias(c) for c in ("place", "block", "row", "source_", "tag", "marks", "key")))
    whole = mixing.mixed_documents(clash, parts, block_docs=1)
    assert whole.columns == clash.columns and sorted(map(str, whole.collect())) == sorted(map(str, clash.collect()))
    order = [(r["doc_id"] is None, r["doc_id"]) for r in whole.coalesce(1).collect()]
    want = [(r["doc_id"] is None, r["doc_id"]) for r in sorted(mixing.mix_sources(clash, parts, block_docs=1).collect(), key=lambda r: r["slot"])]
    assert sorted(order) == sorted(want)


def test_mixing_of_a_hot_source_and_missing_ids(spark):
    d = spark.range(3000).selectExpr("if(id % 3 = 0, null, id div 6) doc_id", "case when id % 3 < 2 then 'hot' else concat('s', id % 11) end source", "id n_chars")
    rows = mixing.mix_sources(d, block_docs=4).collect()
    assert len(rows) == 3000 and len({(r["slot"], r["place"]) for r in rows}) == 3000
    laid = schedule(mixing.natural_parts({s: sum(r["source"] == s for r in rows) for s in {r["source"] for r in rows}}), max(r["slot"] for r in rows) + 1)
    assert all(laid[r["slot"]] == (r["source"], r["block"]) for r in rows)


def test_edf_keeps_every_share(spark):
    parts = {"a": 503, "b": 250, "c": 130, "d": 100, "e": 17}
    slots = {r["slot"]: r["source"] for r in mixing.edf_period(spark, parts).collect()}
    done = dict.fromkeys(parts, 0)
    for t in range(1000):
        done[slots[t]] += 1
        assert all(abs(done[s] - parts[s] * (t + 1) / 1000) < 1 for s in parts)


def test_unigram(docs, none):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = Tokenizer(models.Unigram(unigram.vocabulary(path), 0, True))
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(prepend_scheme="always")])
    for r in unigram.count_tokens(docs.where("doc_id < 15"), path).collect():
        assert r["n_tokens"] == len(library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids)
    assert unigram.count_tokens(none, path).count() == 0


def test_license(docs, none):
    rows = by_id(license.license_scan(docs))
    r = rows[13]
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (9, 3, 3, 7, "cc-by,mit")
    assert rows[0]["n_words"] == 0 and rows[0]["first_word"] is None and rows[0]["labels"] == ""
    assert license.license_scan(docs).count() == len(TEXTS) + 2 and license.license_scan(none).count() == 0


def plain_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w, spots = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low), []
    for phrase, label in license.PHRASES.items():
        p = phrase.split()
        spots += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in spots]
    return len(w), len(spots), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in spots}))


def test_license_base_over_a_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in d.select("doc_id", "text").collect()}
    for r in license.license_scan(d).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == plain_places(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_of_rows_that_share_an_id(spark):
    rows = [(1, "released under the mit license"), (1, "nothing here"), (None, "released under the mit license"), (None, "x"), (1, "nothing here")]
    got = sorted((r["doc_id"] or 0, r["labels"], r["score"]) for r in license.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, "", 0.0), (0, "mit", 1.0), (1, "", 0.0), (1, "", 0.0), (1, "mit", 1.0)]


def test_license_of_one_very_common_line(spark):
    d = spark.range(4000).selectExpr("id doc_id", "if(id % 3 = 0, 'Released under the MIT License', concat('text ', id)) text")
    assert license.license_scan(d).where("labels = 'mit' and score = 1").count() == 1334


def test_license_join_against_all_pairs(spark):
    r = np.random.default_rng(2)
    lines = []
    for _, t in license.TEMPLATES:
        w = t.split()
        lines += [" ".join(w[k] for k in r.permutation(len(w))[: len(w) - cut]) for cut in range(4)]
    got = {(x["block"], x["template"]) for x in license.template_matches(license.with_rows(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string"))).collect()}
    want = {(i, k) for i, line in enumerate(lines) for k, (_, t) in enumerate(license.TEMPLATES) if len(set(line.split()) & set(t.split())) >= license.THRESHOLD * len(set(t.split()))}
    assert got == want


def test_license_lines_that_differ_in_a_name(spark):
    want = {
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa",
        "Licensed under CC BY-ND 4.0.": "cc-by",
        "Licensed under CC BY 4.0.": "cc-by",
        "Licensed under the License, Version 2.0": "",
        "Licensed under the Apache License, Version 2.0": "apache",
        "This Source Code Form is subject to the terms of the Eclipse Public License": "",
        "This Source Code Form is subject to terms of the Mozilla Public License": "mpl",
        "Redistribution in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    }
    got = by_id(license.license_scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")))
    assert [got[k]["labels"] for k in range(len(want))] == list(want.values())
    assert got[2]["score"] == 1.0 and got[4]["score"] == 0.0


def test_license_wrapped_notices(spark):
    texts = [
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
        " * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the Software)",
        "This work is licensed under a Creative Commons\nAttribution 4.0 International License.",
        "Some words.\n\nAll rights reserved. No part of this\r\npublication may be reproduced.\n\nMore words\nhere.",
        "x y\n" * 40 + "Redistribution and use in source or binary forms with\nor without modification are permitted if the following\nconditions are met" + "\nz" * 40,
        "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted provided that the following conditions\n \nare met:",
        "Licensed under CC BY 4.0.\nSA is the next word",
        "Redistribution and use in source and binary forms\n" + "x y\n" * 40 + "with or without modification are permitted provided that the following conditions are met",
        "\n",
        None,
    ]
    want = ["bsd", "mit", "cc-by", "all-rights-reserved", "bsd", "", "cc-by", "", "", ""]
    got = by_id(license.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[k]["labels"] for k in range(len(want))] == want
    assert got[0]["score"] == 1.0 and 0.85 <= got[4]["score"] < 1.0
    wrapped = []
    for _, t in license.TEMPLATES:
        w = t.split()
        for n in (2, 3, 4):
            wrapped.append("\n".join(" ".join(w[k : k + n]) for k in range(0, len(w), n)))
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(wrapped)], "doc_id long, text string")
    found = {(r["row"]["doc_id"], r["label"]) for r in license.wrapped_matches(license.with_rows(rows)).where("containment = 1").collect()}
    assert {(k, license.TEMPLATES[k // 3][0]) for k in range(len(wrapped))} <= found


def test_bpe(docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    for r in bpe.bpe_digest(docs.where("doc_id is not null"), path, with_ids=True).collect():
        ids = library.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_digest(none, path).count() == 0 and bpe.bpe_encode(docs, path).count() == len(TEXTS) + 2


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()
    assert {r["node"]: r["component"] for r in got} == {k: 0 for k in range(51)} | {100: 100, 101: 100}


def test_pipeline(spark):
    """Every stage on its own input: rows against brute force, the classifier's choice taken as given."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, after, stages = docs.columns, [docs], corpus_pipeline.STAGES
    for _, stage in stages:
        after.append(Scratch(spark, "p").table("t", stage(spark, after[-1], sf)))
    rows = [{r["doc_id"]: r for r in d.collect()} for d in after]
    assert all(d.columns == names for d in after[:-1]) and 100 < len(rows[5]) <= len(rows[0])
    scores = {r["doc_id"]: r["accepted"] for r in quality.quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet"), Scratch(spark, "t")).collect()}
    assert rows[1] == {k: r for k, r in rows[0].items() if scores[k]}
    home = components({k: shingles(r["text"]) for k, r in rows[1].items()})
    assert rows[2] == {k: r for k, r in rows[1].items() if home[k] == k}
    order = sorted(rows[2])
    assert rows[3].keys() == rows[2].keys()
    assert [rows[3][k]["text"] for k in order] == cut_texts([rows[2][k]["text"] for k in order])
    assert all(r["n_chars"] == len(r["text"]) for r in rows[3].values())
    assert rows[4] == rows[3]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    assert {k: r["ids"] for k, r in rows[5].items()} == {k: library.encode(r["text"] or "", add_special_tokens=False).ids for k, r in rows[4].items()}


def test_pipeline_of_an_empty_table_and_odd_rows(spark, docs, none):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for d in (none, docs.select("*", *(docs["slot"].alias(c) for c in ("tag", "place", "marks", "component_id")))):
        names = d.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = d.count()
            d = Scratch(spark, "p").table("t", stage(spark, d, "/root/testdata/sf0.001"))
            assert d.count() <= before and (k == 4 or d.columns == names)
