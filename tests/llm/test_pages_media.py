"""HTML extraction and Ogg."""

import itertools
import random
import struct
import time

import numpy as np

from loomsift.llm import htmlcrf, ogg


def test_blocks_of_broken_markup():
    page = "<!-- <p>no --><title>no</title><script>var a='<p>no</p>'</script><body><nav><ul><li><a href=x>one</a><li>two</ul></nav><p>a <b>b<br>c<p>d &amp; e</div></p><div class='ad x'>f</DIV>g"
    got = [(b.text, [t for t, _ in b.path], b.linked) for b in htmlcrf.blocks(page)]
    assert [g[0] for g in got] == ["one", "two", "a b c", "d & e", "f", "g"]
    assert got[0][1] == ["body", "nav", "ul", "li"] and got[0][2] == 3 and got[1][2] == 0
    assert got[2][1] == got[3][1] == ["body", "p"] and htmlcrf.blocks(page)[4].path[-1] == ("div", "ad x")
    assert htmlcrf.blocks("") == [] and htmlcrf.blocks("<p></p><<>") != [] and [b.text for b in htmlcrf.blocks("plain")] == ["plain"]


def test_markup_is_read_as_browsers_do():
    text = lambda page: [b.text for b in htmlcrf.blocks(page)]
    assert text("<p title=it's>hello</p><p>don't stop</p><p>bye</p>") == ["hello", "don't stop", "bye"]
    assert text("<p class=\"a>b\">one</p><p x='<p>'>two") == ["one", "two"] and text("a < b <3 c<p>d") == ["a < b <3 c", "d"]
    assert text("<title>a<p>b</p></title><p>c<textarea><p>d</textarea>e") == ["c e".replace(" ", "")]
    assert text("<SCRIPT>x</scripty></script ><p>y<!--><p>z</p>--><style>s") == ["y", "z", "-->"]
    assert text("a</>b<?php c ?>d<!doctype html>e<p>f<a href='g") == ["abde", "f"]
    assert [b.path for b in htmlcrf.blocks("<div class=A id='b'><br/><img class=c>x<section/>y")] == [(("div", "a b"),)] * 2
    deep = htmlcrf.blocks("<div>" * 2000 + "x" + "</div>" * 2000 + "<p>y")
    assert [len(b.path) for b in deep] == [512, 1]


def test_time_grows_with_the_page():
    pages = ['<a "x' * 200_000, "<" * 1_000_000, "<div>a" * 100_000, "<!--" * 250_000, "<p x='" * 160_000, "</x>" * 250_000, "<div>" * 100_000 + "</q>" * 100_000, "<script>" * 120_000, "<p a" + " " * 1_000_000, "<p " + "a " * 500_000, "<p>" + "=" * 1_000_000]
    for page in pages:
        began = time.perf_counter()
        htmlcrf.blocks(page)
        assert time.perf_counter() - began < 5, page[:20]


def test_gradient_against_differences_and_enumeration():
    rng = np.random.default_rng(4)
    pages = [[rng.integers(1, 30, 3).tolist() for _ in range(n)] for n in (1, 4, 6, 3)]
    labels = [rng.integers(0, 2, len(p)).tolist() for p in pages]
    theta = [np.zeros(htmlcrf.WIDTH), rng.standard_normal((2, 2)), rng.standard_normal(2)]
    theta[0][:30] = rng.standard_normal(30)

    def score(page, y):
        return sum(theta[0][b].sum() * k for b, k in zip(page, y)) + sum(theta[1][a, b] for a, b in zip(y, y[1:])) + theta[2][y[0]]

    group = htmlcrf._Group(pages, labels)
    value, gradient = group.gradient(*theta)
    assert np.isclose(value, sum(score(p, y) - np.log(sum(np.exp(score(p, z)) for z in itertools.product((0, 1), repeat=len(p)))) for p, y in zip(pages, labels)))
    for k, places in enumerate(([(i,) for i in range(30)], list(np.ndindex(2, 2)), [(0,), (1,)])):
        for at in places:
            moved = [t.copy() for t in theta]
            moved[k][at] += 1e-5
            assert np.isclose((group.gradient(*moved)[0] - value) / 1e-5, gradient[k][at], atol=1e-3)


def test_groups_of_pages_give_what_all_at_once_give(monkeypatch):
    rng = np.random.default_rng(6)
    pages = [[rng.integers(1, 50, 3).tolist() for _ in range(n)] for n in rng.integers(0, 12, 40)]
    labels = [rng.integers(0, 2, len(p)).tolist() for p in pages]
    whole = htmlcrf.train(pages, labels, rounds=5)
    decoded = htmlcrf.viterbi(whole, pages)
    monkeypatch.setattr(htmlcrf, "CELLS", 20)
    parts = htmlcrf.train(pages, labels, rounds=5)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.moves, parts.moves)
    assert all((a == b).all() for a, b in zip(decoded, htmlcrf.viterbi(whole, pages)))
    found = htmlcrf.blocks(_page(random.Random(1))[0])
    assert np.allclose(htmlcrf.emissions(whole.weights, found), [whole.weights[f].sum() for f in htmlcrf.features(found)])


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(3)
    model = htmlcrf.Crf(rng.standard_normal(htmlcrf.WIDTH), rng.standard_normal((2, 2)), rng.standard_normal(2))
    pages = [[rng.integers(1, htmlcrf.WIDTH, 4).tolist() for _ in range(n)] for n in (1, 5, 8, 0, 3)]
    for page, got in zip(pages, htmlcrf.viterbi(model, pages)):
        def value(y):
            return sum(model.weights[b].sum() * k for b, k in zip(page, y)) + sum(model.moves[a, b] for a, b in zip(y, y[1:])) + (model.first[y[0]] if y else 0)

        assert np.isclose(value(tuple(got)), max(value(y) for y in itertools.product((0, 1), repeat=len(page))))


def _page(rng, marked=True):
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    body, truth = [], []
    for _ in range(rng.randint(2, 8)):
        text = " ".join(word() for _ in range(rng.randint(8, 40))).capitalize() + "."
        body.append(f"<p>{text}</p>")
        truth.append(text)
    menu = "".join(f"<li><a href='/{word()}'>{word()}</a></li>" for _ in range(rng.randint(2, 6)))
    box = "article" if marked else "section"
    return f"<html><body><ul>{menu}</ul><div class='promo'>{word()} {word()}</div><{box}>{''.join(body)}</{box}><footer>{word()} 2024</footer></body></html>", "\n".join(truth)


def test_extraction_learns_from_marked_pages_and_holds_on_others(spark):
    rng = random.Random(5)
    marked = [(i, _page(rng)[0], "t", 1) for i in range(120)]
    model = htmlcrf.fit(spark.createDataFrame(marked, "page_id long, html string, text string, blocks int"))
    plain = [(i, *_page(rng, False)) for i in range(60)]
    df = spark.createDataFrame([(i, h, "t", 1) for i, h, _ in plain], "page_id long, html string, text string, blocks int")
    got = {r.page_id: r.text for r in htmlcrf.extract(df, model).collect()}
    assert sum(got[i] == t for i, _, t in plain) >= 55


def test_extraction_of_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "<p>only</p>"), (None, "<p>a</p>"), (3, "<p>only</p>"), (4, "<p>" + "long " * 100_000)]
    got = htmlcrf.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == 6 and by[1].text is None and by[2].text is None and by[1].blocks == 0
    assert by[3].text == "only" and by[None].text == "a" and len(by[4].text) == 499_999
    assert htmlcrf.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


# ---- Ogg


def test_checksum_bit_by_bit():
    def slow(data):
        crc = 0
        for b in data:
            crc ^= b << 24
            for _ in range(8):
                crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
        return crc

    for data in (b"", b"\0", b"OggS", bytes(range(256)) * 3):
        assert ogg.checksum(data) == slow(data)


def _mux(rng, streams=3, packets=40):
    sent, pages = {}, []
    for s in range(streams):
        w = ogg.Writer(100 + s, fill=rng.choice([1, 300, 4096]))
        head = [ogg.opus_head(), ogg.vorbis_head(22050), b"\x80theora" + bytes(15) + struct.pack(">II", 25, 1) + bytes(10) + struct.pack(">H", 6 << 5)][s % 3]
        own = [head] + [rng.randbytes(rng.choice([0, 1, 254, 255, 256, 510, 3000, 70_000])) for _ in range(packets)]
        out = [w.packet(p, 1000 * i) for i, p in enumerate(own)] + [w.flush(end=True)]
        sent[100 + s] = own
        pages.append([p for p in out if p])
    data = b""
    while any(pages):
        data += rng.choice([p for p in pages if p]).pop(0)
    return sent, data


def test_round_trip():
    rng = random.Random(7)
    for _ in range(6):
        sent, data = _mux(rng)
        got, granules = {}, {}
        for serial, link, codec, number, packet, granule, seconds, gap in ogg.packets(b"junk OggS" + data):
            assert link == 0 and not gap and number == len(got.setdefault(serial, []))
            got[serial].append(packet)
            if granule is not None:
                granules[serial, number] = granule
        assert got == sent
        assert granules[100, 40] == granules[101, 40] == 40_000  # the last of a page is at its granule


def _mux_audio(codec, sizes, per_page, head, rest=(), start=0, trim=0):
    """Packets in pages of per_page; returns the file and where each packet ends."""
    w, out, ends, at = ogg.Writer(9, fill=1 << 30), [], [], start
    for p in (head, *rest):
        out += [w.packet(p, 0), w.flush()]
    for i, (packet, size) in enumerate(sizes):
        at += size
        ends.append(at)
        out.append(w.packet(packet, at - (trim if i == len(sizes) - 1 else 0)))
        if i % per_page == per_page - 1 and i < len(sizes) - 1:
            out.append(w.flush())
    out.append(w.flush(end=True))
    return b"".join(out), [min(e, at - trim) for e in ends]


def _bits(*fields):
    value = at = 0
    for x, n in fields:
        value, at = value | x << at, at + n
    return value.to_bytes(-(-at // 8), "little")


def test_every_packet_has_its_time():
    rng = random.Random(11)
    toc = {0: 480, 3: 2880, 9: 960, 13: 960, 16: 120, 19: 960, 31: 960}
    opus = []
    for _ in range(40):
        config, code, n = rng.choice(list(toc)), rng.randrange(4), rng.randint(1, 6)
        opus.append((bytes([config << 3 | code, n]) + rng.randbytes(20), toc[config] * (1, 2, 2, n)[code]))
    # blocks of 256 and 2048 by four modes, as the setup header's end says
    flags = [0, 1, 1, 0]
    setup = b"\x05vorbis" + rng.randbytes(60) + _bits((0x2A, 7), (3, 6), *[x for f in flags for x in ((f, 1), (0, 16), (0, 16), (5, 8))], (1, 1))
    vorbis, last = [], None
    for _ in range(40):
        mode = rng.randrange(4)
        size = (256, 2048)[flags[mode]]
        vorbis.append((bytes([mode << 1]) + rng.randbytes(9), 0 if last is None else (last + size) // 4))
        last = size
    mixed_head = ogg.vorbis_head()[:28] + b"\xb8\x01"
    flac_head = b"\x7fFLAC" + bytes(22) + (48000 << 4).to_bytes(3, "big") + bytes(20)
    flac = [(b"\xff\xf8" + bytes([c << 4, 0, 5]) + tail + b"zz", n) for c, tail, n in ((1, b"", 192), (5, b"", 4608), (12, b"", 4096), (6, b"\x09", 10), (7, b"\x01\x00", 257), (9, b"", 512))] * 5
    speex_head = b"Speex   " + bytes(28) + struct.pack("<I", 16000) + bytes(16) + struct.pack("<I", 320) + bytes(4) + struct.pack("<I", 2) + bytes(12)
    cases = [
        ("opus", opus, ogg.opus_head(), [b"OpusTags"]), ("vorbis", vorbis, mixed_head, [b"\x03vorbis", setup]), ("flac", flac, flac_head, [b"\x84tags"]),
        ("speex", [(b"s" * 9, 640)] * 30, speex_head, [b"comment"]),
    ]
    for codec, audio, head, rest in cases:
        for trim in (0, 100):
            data, ends = _mux_audio(codec, audio, 7, head, rest, trim=trim)
            got = list(ogg.packets(data))
            assert [g[2] for g in got] == [codec] * len(got) and [g[5] for g in got] == [0] * (1 + len(rest)) + ends, codec
            assert all(g[6] is not None for g in got)
    shift = 6
    theora_head = b"\x80theora" + bytes(15) + struct.pack(">II", 25, 1) + bytes(10) + struct.pack(">H", shift << 5)
    w = ogg.Writer(3, fill=1 << 30)
    data = w.packet(theora_head, 0) + w.flush() + b"".join(w.packet(b"\x00f", (i // 10 * 10) << shift | i % 10) + (w.flush() if i % 6 == 5 else b"") for i in range(30)) + w.flush(end=True)
    assert [g[5] for g in ogg.packets(data)][1:] == list(range(30))


def test_times():
    clock = ogg._Clock(ogg.opus_head(312))
    assert clock.seconds(48_312) == 1.0 and clock.seconds(-1) is None and clock.seconds(0) == 0
    assert ogg._Clock(ogg.vorbis_head(44100)).seconds(88_200) == 2.0
    theora = ogg._Clock(b"\x80theora" + bytes(15) + struct.pack(">II", 25, 1) + bytes(10) + struct.pack(">H", 6 << 5))
    assert theora.codec == "theora" and theora.seconds(theora.place((50 << 6) + 25)) == 3.0
    assert ogg._Clock(b"?").seconds(5) is None


def test_damage_costs_only_what_it_touches():
    rng = random.Random(8)
    sent, data = _mux(rng, streams=1, packets=60)
    starts = [i for i in range(len(data)) if data.startswith(b"OggS", i)]
    hurt = bytearray(data)
    hurt[starts[len(starts) // 2] + 40] ^= 1
    got = list(ogg.packets(bytes(hurt)))
    assert 0 < len(got) < len(sent[100]) and any(g[7] for g in got)
    whole = list(sent[100])
    at = 0
    for g in got:  # what is left are whole packets, in order
        at = whole.index(g[4], at) + 1


def test_media_table_and_odd_values(spark):
    rows = [(1, "a\nb\nc\n" + "z" * 200_000), (2, ""), (3, None), (None, "x"), (1, "a")]
    media = ogg.media_table(spark.createDataFrame(rows, "doc_id long, text string"))
    got = ogg.demux(media).collect()
    assert sum(r.doc_id == 1 for r in got) == 2 * 2 + 4 + 1 and {r.doc_id for r in got} == {1, 2, None}
    assert max(r.bytes for r in got) == 200_001 and not any(r.gap for r in got) and all(r.seconds is not None for r in got)
    whole = ogg.demux(media.selectExpr("doc_id as SERIAL", "media"), key="SERIAL", payload=True)
    assert whole.columns[0] == "SERIAL_" and sorted(r.payload[1:] for r in whole.where("SERIAL_ = 1 and codec = 'opus' and packet > 0").collect()) == [b"a", b"a", b"c"]
    odd = spark.createDataFrame([(1, b"no ogg"), (2, None), (3, b"OggS"), (4, bytearray(media.first().media)[:5000])], "doc_id long, media binary")
    assert {r.doc_id for r in ogg.demux(odd).collect()} <= {4}
    assert ogg.demux(media.limit(0)).count() == 0
