import hashlib
import json
import os
import stat

import pytest
from pyspark.sql import functions as F

from paperlode import cli
from paperlode.errors import ChecksumMismatch, CorpusError, InvalidConfig, InvalidExtraction, InvalidManifest, JsonError, ReadError, SizeMismatch
from paperlode.plans import queries
from paperlode.plans.corpus import Engine, generated_at
from paperlode.sources import artifacts, config
from paperlode.sources.bbox import parse_bbox_layout
from paperlode.sources.toolchain import PopplerToolchain

SOURCE = b"hello world\n"
BOX = 'xMin="1" yMin="2" xMax="3" yMax="4"'


def xhtml(*texts, box=BOX):
    pages = "".join(f'<page width="595" height="842"><flow><block {box}><line {box}>' + "".join(f"<word {box}>{w}</word>" for w in t.split()) + "</line></block></flow></page>" for t in texts)
    return f'<html xmlns="http://www.w3.org/1999/xhtml"><head><title></title></head><body><doc>{pages}</doc></body></html>'


def manifest(cadre="CHO", side="text", **more):
    return dict(
        source_id=f"{cadre.lower()}-{side}", title="t", cadre=cadre, edition="2024", representation=side, official_url="https://chprbn.gov.ng/x.pdf", retrieved_at="2026-07-14",
        byte_size=12, sha256=hashlib.sha256(SOURCE).hexdigest(), page_count=2, local_path=f"pdf/{cadre}-{side}.pdf",
    ) | more


@pytest.fixture
def repo(tmp_path):
    def write(name, value):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(value if isinstance(value, bytes) else json.dumps(value).encode())

    for side in ("text", "illustrated"):
        write(f"m/{side}.json", manifest(side=side))
        write(f"pdf/CHO-{side}.pdf", SOURCE)
    write("corpus.json", {"schema_version": 1, "derived_path": "derived", "pairs": [{"cadre": "CHO", "text": "m/text.json", "illustrated": "m/illustrated.json"}]})
    layout = "2.3 FEVER\\nGive 5 mg IM\\nPAGE 7\\n\\fPAGE 8\\nBody\\n"
    write("tools/pdfinfo", b"#!/bin/sh\nif [ \"$1\" = -v ]; then echo 'pdfinfo version 26.04.0' >&2; exit 0; fi\nprintf 'Pages: 2\\nEncrypted: no\\nFile size: 12 bytes\\nPDF version: 1.7\\n'\n")
    write("tools/pdftotext", f"#!/bin/sh\nif [ \"$1\" = -v ]; then echo 'pdftotext version 26.04.0' >&2; exit 0; fi\nfor last; do :; done\nif [ \"$1\" = -layout ]; then printf '{layout}' > \"$last\"; else cat > \"$last\" <<'X'\n{xhtml('PAGE 7', 'PAGE 8')}\nX\nfi\n".encode())
    for t in ("pdfinfo", "pdftotext"):
        os.chmod(tmp_path / "tools" / t, stat.S_IRWXU)
    return tmp_path, write


def tools(root):
    return PopplerToolchain.probe(str(root / "tools/pdfinfo"), str(root / "tools/pdftotext"))


def test_verify_and_tools(spark, repo):
    root, _ = repo
    found = tools(root)
    meta = found.pdf_metadata(str(root / "pdf/CHO-text.pdf"))
    assert (found.version, meta.pages, meta.encrypted, meta.file_size, meta.pdf_version) == ("26.04.0", 2, False, 12, "1.7")
    got = Engine(spark, str(root), found).verify("corpus.json")
    assert got["poppler_version"] == "26.04.0" and [s["source_id"] for s in got["sources"]] == ["cho-text", "cho-illustrated"]
    with pytest.raises(CorpusError):
        PopplerToolchain.probe(str(root / "tools/none"), str(root / "tools/pdftotext"))


def test_run_publishes_a_reproducible_corpus(spark, repo, monkeypatch):
    root, write = repo
    monkeypatch.setenv("SOURCE_DATE_EPOCH", "77")
    engine = Engine(spark, str(root), tools(root))
    first = engine.run("corpus.json")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert engine.run("corpus.json") == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert first["generated_at"] == "unix:77" and first["blocking_issues"] == 0
    (c,) = first["comparisons"]
    assert (c["dose_like_pages"], c["dose_pages_accounted"], c["dose_candidates"], c["pending_clinical_review"]) == (1, 1, 1, 1)
    names = sorted(os.path.relpath(os.path.join(d, f), root / "derived") for d, _, fs in os.walk(root / "derived") for f in fs)
    per = ["bbox.xhtml", "dose-candidates.jsonl", "dose-like-pages.jsonl", "headings.jsonl", "layout.txt", "pages.jsonl", "source.json"]
    assert names == sorted(
        [".gitkeep", "report.md", "run.json", *(f"comparisons/CHO/{x}" for x in ("dose-comparisons.jsonl", "heading-alignments.jsonl", "reference-validation.jsonl", "report.json", "report.md"))]
        + [f"sources/cho-{s}/{x}" for s in ("text", "illustrated") for x in per]
    )
    page = json.loads((root / "derived/sources/cho-text/pages.jsonl").read_text().splitlines()[0])
    assert (page["physical_page"], page["printed_page_label"], page["width"], page["blocks"][0]["lines"][0]["words"][0]["text"]) == (1, "7", 595.0, "PAGE")
    row = json.loads((root / "derived/sources/cho-text/dose-candidates.jsonl").read_text())
    assert row["comparison_status"] == "match" and row["heading_section"] == "2.3"
    assert json.loads((root / "derived/run.json").read_text()) == first == json.loads(json.dumps(first))
    assert first["semantic_artifact_sha256"] == artifacts.folder_digest(str(root / "derived"))
    write("corpus/reviews/a.json", {"schema_version": 1, "candidate_id": row["candidate_id"], "content_hash": "0" * 64, "text_source_id": "cho-text", "illustrated_source_id": "cho-illustrated", "reviewer": "r", "reviewed_at": "2026-01-01", "decision": "approved", "notes": "n"})
    assert cli.main(["--repo-root", str(root), "run", "--config", "corpus.json"], engine) == 1
    assert json.loads((root / "derived/run.json").read_text())["blocking_issues"] == 1
    write("corpus/reviews/b.json", {"schema_version": 1})
    before = (root / "derived/run.json").read_text()
    with pytest.raises(JsonError):
        engine.run("corpus.json")
    assert (root / "derived/run.json").read_text() == before and not [x for x in os.listdir(root) if x.startswith("derived.")]


def test_cli(spark, repo, capsys):
    root, _ = repo
    engine = Engine(spark, str(root), tools(root))
    assert cli.main(["verify", "--config", "corpus.json"], engine) == 0
    assert capsys.readouterr().out == "verified 2 sources with Poppler 26.04.0\n"
    assert cli.main(["extract", "--config", "nothing.json"], engine) == 1
    for wrong in (["run"], ["other", "--config", "x"], ["run", "--config"]):
        with pytest.raises(SystemExit) as e:
            cli.main(wrong, engine)
        assert e.value.code == 2
    for name in ("extract", "compare", "run", "verify"):
        assert name in cli.parser().format_help()


def test_config_faults(repo):
    root, write = repo
    pair = {"cadre": "CHO", "text": "m/text.json", "illustrated": "m/illustrated.json"}

    def load(pairs, version=1):
        write("c.json", {"schema_version": version, "derived_path": "d", "pairs": pairs})
        return config.load_config(str(root), "c.json")

    assert len(load([pair])["pairs"][0]["manifests"]) == 2
    for pairs, version in (([pair], 2), ([pair, pair], 1), ([pair | {"illustrated": "m/text.json"}], 1), ([pair | {"cadre": "CHEW"}], 1), ([{"cadre": "CHO", "text": "m/illustrated.json", "illustrated": "m/text.json"}], 1)):
        with pytest.raises(InvalidConfig):
            load(pairs, version)
    with pytest.raises(ReadError):
        load([pair | {"text": "m/none.json"}])
    with pytest.raises(JsonError):
        load([pair | {"cadre": "XYZ"}])
    write("c.json", b"{")
    with pytest.raises(JsonError):
        config.load_config(str(root), "c.json")


def test_manifest_faults(spark, repo):
    root, _ = repo
    assert config.verify_sources(spark, str(root), [manifest()])[0]["verified_sha256"] == manifest()["sha256"]
    for more in ({"official_url": "http://chprbn.gov.ng/"}, {"local_path": "/etc/x"}, {"local_path": "a/../b"}, {"retrieved_at": "2026/07/14"}, {"page_count": 0}, {"sha256": "x" * 64}):
        with pytest.raises(InvalidManifest):
            config.verify_sources(spark, str(root), [manifest(**more)])
    with pytest.raises(SizeMismatch):
        config.verify_sources(spark, str(root), [manifest(byte_size=13)])
    with pytest.raises(ChecksumMismatch):
        config.verify_sources(spark, str(root), [manifest(sha256=manifest()["sha256"].upper())])
    with pytest.raises(ReadError):
        config.verify_sources(spark, str(root), [manifest(local_path="no.pdf")])


def test_tables_in_folders_are_verified_as_one(spark, tmp_path, monkeypatch):
    for name in queries.TABLES:
        if name in ("lineitem", "nation", "supplier"):
            (tmp_path / f"{name}.parquet").mkdir()
            for i in range(3):
                (tmp_path / f"{name}.parquet/part-{i}.parquet").write_bytes(b"x" * i + name.encode())
        else:
            (tmp_path / f"{name}.parquet").write_bytes(name.encode())
    want = {f"{n}.parquet": "ok" for n in queries.TABLES} | {"nation.parquet": "size_mismatch", "supplier.parquet": "checksum_mismatch", "lost.parquet": "missing"}
    paths = [f"{tmp_path}/{n}.parquet" for n in queries.TABLES]
    once = sorted(config.digests(spark, paths).collect())
    assert [r.sha256 for r in once if r.path == "orders.parquet"] == [hashlib.sha256(b"orders").hexdigest()]
    for limit in (config.STREAMED, 6):  # files over the limit are hashed as streams, to the same
        monkeypatch.setattr(config, "STREAMED", limit)
        rows = queries.q_source_verification(spark, str(tmp_path)).collect()
        assert sorted((r.path, r.status) for r in rows) == sorted(want.items())
        assert sorted(config.digests(spark, paths).collect()) == once
    (tmp_path / "lineitem.parquet/part-1.parquet").write_bytes(b"ylineitem")
    assert sorted(config.digests(spark, paths).collect()) != once


def boxes(spark, x):
    return spark.createDataFrame([(x,)], "x string").select(parse_bbox_layout(F.col("x")).alias("p")).first().p


def test_boxes(spark):
    got = boxes(spark, xhtml("PAGE 7 A&amp;B", "x"))
    assert [w.text for w in got[0].blocks[0].lines[0].words] == ["PAGE", "7", "A&B"] and len(got) == 2 and got[0].width == 595.0
    assert abs(boxes(spark, xhtml("a", box=BOX.replace('"1"', '"-0.289818"')))[0].blocks[0].x_min + 0.289818) < 1e-6
    for bad in (xhtml("a", box=BOX.replace('"3"', '"-1"')), xhtml("a", box=BOX.replace('"3"', '"NaN"')), xhtml("a", box='xMin="1" yMin="2" xMax="3"'), xhtml()):
        with pytest.raises(Exception, match="invalid extraction output"):
            boxes(spark, bad)


def test_boxes_are_parsed_once_and_whole(spark):
    word = lambda t: f"<word {BOX}>{t}</word>"
    doc = f'<doc><page width="1" height="2"><block {BOX}><line {BOX}>{word("a<!-- x -->c")}{word("a<i>b</i>c")}{word(" ")}{word("")}{word(" d ")}</line><line {BOX}/></block><flow><block {BOX}/></flow><flow/></page></doc>'
    (page,) = boxes(spark, doc)
    assert [[[w.text for w in x.words] for x in b.lines] for b in page.blocks] == [[], [["ac", "ac", "", "", " d "], []]]
    df = spark.createDataFrame([(xhtml("a b"),), (doc,)] * 3, "x string").coalesce(1).select(F.posexplode(parse_bbox_layout(F.col("x"))))
    assert df.count() == 6 and "from_xml" not in df._jdf.queryExecution().toString()
    for wrong in ("<html", None):
        with pytest.raises(Exception, match="invalid extraction output"):
            boxes(spark, wrong)


def test_writers_and_digest(spark, tmp_path):
    df = spark.createDataFrame([(2, None, 1.5), (1, "é", 595.0)], "a long, b string, c float")
    for name in ("x", "y"):
        artifacts.write_jsonl(f"{tmp_path}/{name}/r.jsonl", df.repartition(3), ["a", "b", "c"], ["a"])
    assert (tmp_path / "x/r.jsonl").read_text() == '{"a":1,"b":"é","c":595.0}\n{"a":2,"b":null,"c":1.5}\n' == (tmp_path / "y/r.jsonl").read_text()
    artifacts.write_json(f"{tmp_path}/z/run.json", {"a": "é"})
    assert (tmp_path / "z/run.json").read_text() == '{\n  "a": "é"\n}\n'
    files = [("b", b"2"), ("a/x", b"1")]
    assert artifacts.semantic_digest(files) == artifacts.semantic_digest(files[::-1]) != artifacts.semantic_digest([("b", b"1"), ("a/x", b"2")])
    rows = spark.createDataFrame([("k", p, c.decode()) for p, c in files], "k string, path string, content string")
    assert artifacts.digest_of(rows, ["k"]).first().digest == artifacts.semantic_digest(files)
    assert artifacts.folder_digest(f"{tmp_path}/z") == artifacts.semantic_digest([])


def test_time_and_errors(monkeypatch):
    monkeypatch.setenv("SOURCE_DATE_EPOCH", "x")
    assert int(generated_at().partition(":")[2]) > 1_700_000_000
    assert str(InvalidExtraction("x")) == "invalid extraction output: x"
