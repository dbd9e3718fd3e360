"""WARC archives and token files: round trips and damage."""

import base64
import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from urllib.parse import unquote

import brute
import pytest
from pyspark.sql import functions as F

from refinery.llm import warc
from refinery.llm.store import open_folder
from refinery.llm.tokens import Encoder, SeekableReader, read_token_files, write_token_files
from refinery.session import scratch_path

PAGES = "page_id long, url string, html string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(2)
    html = [f"<p>{brute.prose(rng, n)}</p>" for n in (0, 5, 50, 500)] + [None, "", "é" * 200_000, "a\r\n\r\nWARC/1.1\r\n"]
    rows = [(i, f"http://x.example/{i}?q=ä b" if i % 7 else None, html[rng.randrange(len(html))]) for i in range(90)]
    rows += [rows[5], (None, "http://n.example/", html[1]), (None, None, "only here")]
    df = spark.createDataFrame(rows, PAGES).repartition(4)
    return rows, df.withColumns({c: F.lit(1) for c in ("sha1", "payload", "first", "n", "path")})


def test_warc_round_trip(pages):
    rows, df = pages
    out = warc.round_trip(df, archive_bytes=3_000).collect()
    first, count = {}, Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        count[b] += 1
        first[b] = min((x for x in (first.get(b), i) if x is not None), default=None)
    want = Counter()
    for i, url, h in rows:
        b = (h or "").encode()
        revisit = count[b] > 1 and first[b] is not None and i != first[b]
        want[str(i), len(b), digest(b), "revisit" if revisit else "response", str(first[b]) if revisit else None] += 1
    assert Counter((str(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == want
    assert len({r["path"] for r in out}) > 4 and not any(r["reason"] for r in out)


def test_small_payloads_are_not_revisits(spark):
    df = spark.createDataFrame([(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "x" * 50), (4, "u", "x" * 50)], PAGES)
    out = {r["record_id"]: r["record_type"] for r in warc.round_trip(df, min_revisit_bytes=10).collect()}
    assert out == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_a_very_long_url_comes_back(spark):
    urls = ["http://x.example/" + "a" * 300_000, "http://x.example/" + "中" * 30_000]
    df = spark.createDataFrame([(i, urls[i % 2], f"page {i // 2} ") for i in range(4)], PAGES)
    out = warc.round_trip(df).collect()
    assert {r["record_id"]: (r["record_type"], unquote(r["url"]), r["payload_bytes"], r["reason"]) for r in out} == {
        str(i): ("revisit" if i % 2 else "response", urls[i % 2], 7, None) for i in range(4)} and len(out) == 4
    plain = zlib.decompress(warc.member(warc.record_bytes(1, urls[0], b"x", digest(b"x"), None, False, "2024-01-01T00:00:00Z")), 31)
    assert ids(warc.salvage(plain * 2)) == ["<urn:page:1>"] * 2


def test_an_empty_table_makes_no_archives(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def archive():
    return [warc.member(warc.record_bytes(i, f"http://x/{i}", p, digest(p), None, False, "2024-01-01T00:00:00Z"))
            for i, p in enumerate([b"alpha " * 40, b"beta", b"", b"\x1f\x8b\x08 WARC/1.1 in the text", b"omega" * 900])]


def ids(spans):
    return [h["warc-record-id"] for _, _, found, _ in spans for h, _ in found]


@pytest.mark.parametrize("kind", ["flip", "cut", "insert", "drop", "zero", "tail"])
def test_salvage_recovers_later_records(kind):
    whole = archive()
    for bad in range(len(whole)):
        m = list(whole)
        if kind == "flip":
            b = bytearray(m[bad])
            b[len(b) // 2] ^= 0x55
            m[bad] = bytes(b)
        elif kind == "cut":
            m[bad] = m[bad][:len(m[bad]) // 2]
        elif kind == "insert":
            m[bad] = b"\x1f\x8b\x08junk WARC/1.1 junk" + m[bad]
        elif kind == "drop":
            m[bad] = b""
        elif kind == "zero":
            m[bad] = bytes(len(m[bad]))
        else:
            m[-1] = m[-1][:-5]
        data = b"".join(m)
        spans = list(warc.salvage(data))
        assert [s[0] for s in spans] == [0] + [s[1] for s in spans[:-1]] and spans[-1][1] == len(data)      # no holes
        lost = {"insert": None, "tail": len(whole) - 1}.get(kind, bad)
        assert ids(spans) == [f"<urn:page:{i}>" for i in range(len(whole)) if i != lost]
        gaps = [s for s in spans if s[3]]
        assert len(gaps) == (kind != "drop")
        assert all(data[a:b] and not found for a, b, found, _ in gaps)


def test_salvage_reads_plain_records_and_checks_digests():
    plain = [zlib.decompress(m, 31) for m in archive()]
    assert len(ids(warc.salvage(b"".join(plain)))) == 5
    wrong = plain[1].replace(b"beta", b"bets")
    spans = list(warc.salvage(plain[0] + wrong + plain[2]))
    assert ids(spans) == ["<urn:page:0>", "<urn:page:2>"] and "digest" in [s[3] for s in spans if s[3]][0]
    short = plain[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    assert ids(warc.salvage(plain[0] + short + plain[2])) == ["<urn:page:0>", "<urn:page:2>"]
    assert list(warc.salvage(b"")) == [] and [s[3] for s in warc.salvage(b"no archive")] == ["no version line"]


def test_salvage_goes_on_inside_a_member():
    plain, sound = [zlib.decompress(m, 31) for m in archive()], warc.member(b"")
    for bad in range(5):
        damaged = list(plain)
        damaged[bad] = plain[bad].replace(b"Block-Digest: sha1:", b"Block-Digest: sha1:X")
        data = warc.member(b"".join(damaged)) + archive()[0] + sound
        spans = list(warc.salvage(data))
        assert [s[0] for s in spans] == [0] + [s[1] for s in spans[:-1]] and spans[-1][1] == len(data)
        assert ids(spans) == [f"<urn:page:{i}>" for i in range(5) if i != bad] + ["<urn:page:0>"]
        assert [("digest" in s[3]) for s in spans if s[3]] == [True]


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("kind", ["cut", "edge", "flip", "end"])
def test_salvage_keeps_what_inflates_before_the_damage(level, kind):
    rng = random.Random(level)
    bodies = [rng.randbytes(9_000) for _ in range(40)]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    parts = [z.compress(warc.record_bytes(i, None, b, digest(b), None, False, "2024-01-01T00:00:00Z")) + z.flush(zlib.Z_FULL_FLUSH)
             for i, b in enumerate(bodies)]
    at = sum(map(len, parts[:25]))
    whole = b"".join(parts) + z.flush()
    if kind == "flip":                                    # a block type that does not exist
        whole = whole[:at] + b"\x07" + whole[at + 1:]
    elif kind == "edge":
        whole = whole[:at]
    else:
        whole = whole[:at + 500]
    after = b"" if kind == "end" else b"".join(archive()[:2])
    data = whole + after
    spans = list(warc.salvage(data))
    assert [s[0] for s in spans] == [0] + [s[1] for s in spans[:-1]] and spans[-1][1] == len(data)
    got = ids(spans)
    assert got[:24] == [f"<urn:page:{i}>" for i in range(24)] and len(got) == len(set(got)) + 2 * bool(after)
    assert any(s[3] for s in spans) and all(s[0] < s[1] for s in spans)
    assert not after or got[-2:] == ["<urn:page:0>", "<urn:page:1>"]


def test_reader_logs_gaps(spark, tmp_path):
    m = archive()
    (tmp_path / "a.warc.gz").write_bytes(m[0] + b"garbage" + m[1])
    out = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [(r["record_id"], r["reason"] is not None) for r in out] == [("0", False), (None, True), ("1", False)]
    assert (out[1]["start"], out[1]["end"]) == (len(m[0]), len(m[0]) + 7) and out[0]["payload"] == b"alpha " * 40


# --- token files ---------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def whole_texts(path, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_word_cache_gives_the_ids_of_whole_texts(tokenizer):
    import numpy as np

    rng = random.Random(5)
    signs = " \n\t\r\x0b\x1c\x1f\x85\xa0  　​'sdtlrevm abcéß1²$%.,;!中\U0001F600-_"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["<|endoftext|>", "it's we'll 'S  x\n\n\nW", "a" * 3000, " " * 200, None]
    e = Encoder(tokenizer, 0)
    got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts)]
    assert got == [ids + [0] for ids in whole_texts(tokenizer, texts)]


def test_a_worker_can_drop_its_encoder(tokenizer):
    Encoder.of(tokenizer, 0)
    Encoder.forget()
    assert not Encoder._made


def test_token_files_round_trip(spark, awkward, tokenizer):
    import numpy as np

    rows, df = awkward
    folder = scratch_path(spark, "test-tokens")
    manifest = write_token_files(df, folder, tokenizer, frame_ids=500, file_bytes=1000)
    out = sorted(read_token_files(manifest, folder).collect(), key=lambda r: r["start"])
    want = defaultdict(list)
    for (d, *_), ids in zip(rows, whole_texts(tokenizer, [r[1] for r in rows])):
        want[d].append((len(ids) + 1, zlib.crc32(np.array(ids + [0], "<u4").tobytes())))
    assert [r["doc_id"] for r in out] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in out:
        assert r["start"] == at
        at += r["n_tokens"]
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert not any(want.values()) and manifest.count() > 3
    some = {r["doc_id"] for r in out[5:8]}
    assert {r["doc_id"] for r in read_token_files(manifest, folder, some).collect()} == some


def test_reader_fetches_only_wanted_frames_and_checks_them(spark, tokenizer):
    import zstandard

    df = spark.createDataFrame([(i, f"text number {i} " * 40) for i in range(30)], "doc_id long, text string").coalesce(1)
    folder = scratch_path(spark, "test-frames")
    name = write_token_files(df, folder, tokenizer, frame_ids=300).first()["path"]
    fs, root = open_folder(folder)
    data = fs.open_input_file(f"{root}/{name}").read()

    class File:
        def __init__(self, content):
            self.content, self.asked = content, []

        def size(self):
            return len(self.content)

        def read_at(self, n, offset):
            self.asked.append((offset, n))
            return self.content[offset:offset + n]

    whole = File(data)
    reader = SeekableReader(whole)
    before = len(whole.asked)
    assert [d for _, d, _ in reader.documents({17})] == [17] and len(whole.asked) == before + 1
    assert len(reader.sizes) > 5
    offset = int(reader.offsets[reader.frames[17]])
    broken = SeekableReader(File(data[:offset + 8] + b"\xff\xff\xff" + data[offset + 11:]))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(broken.documents({17}))
    assert [d for _, d, _ in broken.documents({int(reader.ids[reader.frames != reader.frames[17]][0])})]
    # plain zstd readers skip the table and read all frames
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(plain) == int(reader.sizes[:, 1].sum())


def test_token_files_of_an_empty_table(spark, nothing, tokenizer):
    folder = scratch_path(spark, "test-no-tokens")
    manifest = write_token_files(nothing, folder, tokenizer)
    assert manifest.count() == 0 and read_token_files(manifest, folder).count() == 0


def test_only_whole_files_appear(tmp_path):
    from refinery.llm.store import new_file

    with pytest.raises(RuntimeError), new_file(str(tmp_path), "x.bin") as out:
        out.write(b"half")
        raise RuntimeError
    assert "x.bin" not in os.listdir(tmp_path)
    with new_file(f"file:{tmp_path}", "y.bin") as out:
        out.write(b"whole")
    assert (tmp_path / "y.bin").read_bytes() == b"whole"
