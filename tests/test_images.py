"""Image selection and reading."""

import random
import struct

from corpuswright.operators import images as im


def sequential(rows, cap, per_group):
    """Walk down the rank as a person would."""
    out, taken, groups = {}, 0, {}
    for rank, key in rows:
        if cap >= 0 and taken >= cap:
            out[rank] = "page_cap_omitted"
        elif key is not None and groups.get(key, 0) >= per_group:
            out[rank] = "representative_group_omitted"
        else:
            out[rank] = "selected"
            taken += 1
            if key is not None:
                groups[key] = groups.get(key, 0) + 1
    return out


def test_image_select_equals_the_sequential_rule(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for p in range(120):
        cap = rng.choice([-1, 0, 1, 3, 5, 12])
        listed = [(r, rng.choice([None, "a", "b", "c"])) for r in range(1, rng.randint(2, 16))]
        rows += [(f"p{p}", r, k, cap) for r, k in listed]
        want.update({(f"p{p}", r): d for r, d in sequential(listed, cap, 2).items()})
    df = spark.createDataFrame(rows, "document_id string, rank int, group_key string, page_cap int")
    got = {(r.document_id, r.rank): r.decision for r in im.image_select(df, per_group=2).collect()}
    assert got == want


def test_sizes_from_headers(spark):
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 640, 480) + b"\x08\x02\0\0\0"
    gif = b"GIF89a" + struct.pack("<HH", 300, 20)
    jpeg = b"\xff\xd8\xff\xe0\x00\x10JFIF\0\x01\x01\0\0\x01\0\x01\0\0" + b"\xff\xc0\x00\x11\x08" + struct.pack(">HH", 480, 640) + b"\x03" + b"\0" * 12
    rows = [("a/x.png", png), ("a/x.gif", gif), ("a/x.jpg", jpeg), ("a/site-logo.png", png), ("a/t.gif", b"GIF87a" + struct.pack("<HH", 8, 8)), ("a/n.png", None), ("a/z.png", b"zz")]
    df = spark.createDataFrame([(s, "file", c) for s, c in rows], "source string, source_kind string, content binary")
    got = {r.source: (r.width, r.height, r.low_value_reason) for r in im.image_profile(df).collect()}
    assert got["a/x.png"][:2] == (640, 480) and got["a/x.gif"][:2] == (300, 20) and got["a/x.jpg"][:2] == (640, 480)
    assert got["a/site-logo.png"][2] and got["a/t.gif"][2] == "tiny image dimensions 8x8"
    assert got["a/n.png"] == (None, None, None) and got["a/z.png"] == (None, None, None)


def test_discovery_keeps_order_headings_and_context(spark, make_pages):
    md = "# Top\nintro\n![a](attachments/one.png) and ![b](<attachments/two.png>)\nafter\n## \n![c](https://h/download/attachments/1/ONE.PNG?v=1)\n![d](notes.txt)\n![e](https://h/images/icons/x.png)\n![f](https://far/z.jpg)\n"
    pages = make_pages(dict(markdown=md))
    names = spark.createDataFrame([("1", "one.png"), ("1", "other.gif"), ("1", "readme.txt")], "page_id string, name string")
    rows = im.discover_images(pages, names).orderBy("source_order").collect()
    assert [r.source for r in rows] == ["1/attachments/one.png", "1/attachments/two.png", "https://far/z.jpg", "1/attachments/other.gif"]
    assert [r.nearby_heading for r in rows] == ["Top", "Top", None, None]
    assert rows[0].context == "intro\n![a](attachments/one.png) and ![b](<attachments/two.png>)\nafter"
    assert [r.source_kind for r in rows] == ["file", "file", "url", "file"]


def test_headings_and_lines_around_images(spark):
    lines = ["![a](a.png)", "# One ![b](b.png) tail", "text ![c](c.png)![d](d.png)", "#", "![e](e.png)", "## Two", "", "![f](f.png)"]
    long = ["## Start"] + ["words", "![x](x.png)"] * 3000
    rows = [("p", "1", "S", "\n".join(lines)), ("q", "2", "S", "\n".join(long)), ("r", "3", "S", "no image](here"), ("s", "4", "S", None)]
    pages = spark.createDataFrame(rows, "document_id string, page_id string, space_key string, markdown string")
    got = {(r.document_id, r.line, r.in_line): (r.raw, r.nearby_heading, r.context) for r in im.image_references(pages).collect()}

    def around(i):
        return "\n".join(lines[max(i - 1, 0) : i + 2])

    assert {k[1:]: v for k, v in got.items() if k[0] == "p"} == {
        (0, 0): ("a.png", None, around(0)), (1, 0): ("b.png", "One", around(1)), (2, 0): ("c.png", "One ![b](b.png) tail", around(2)),
        (2, 1): ("d.png", "One ![b](b.png) tail", around(2)), (4, 0): ("e.png", None, around(4)), (7, 0): ("f.png", "Two", around(7)),
    }
    assert sum(k[0] == "q" for k in got) == 3000 and {v[1] for k, v in got.items() if k[0] == "q"} == {"Start"}
    assert "_lines" not in im.image_references(pages).columns


def test_export_shows_all_images_unless_limited(spark):
    rows = [("d", i, f"image-{i}", "s", "success", "", f"h{i}", "words " * 600) for i in range(30)]
    images = spark.createDataFrame(rows, "document_id string, rank int, image_id string, source string, status string, caption string, content_sha256 string, ocr_text string")
    every = im.image_dedupe_render(images).collect()
    assert {(r.outcome, r.ocr_cut, r.ocr_shown) for r in every} == {("shown", False, "words " * 600)}
    some = im.image_dedupe_render(images, max_images=4, max_ocr_chars=10).collect()
    assert sorted(r.outcome for r in some) == ["shown"] * 4 + ["truncated"] * 26 and {r.ocr_shown for r in some} == {"words word"}
