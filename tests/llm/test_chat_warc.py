import hashlib
import re

import pytest
from pyspark.sql import functions as F

from hirelake.llm import chat, warc
from hirelake.llm.oracle import ORACLE_SQL
from hirelake.llm.queries import QUERIES

from .conftest import FOLDER

TURNS = "conv_id long, turn long, role string, text string, label string"
TALK = [
    (1, 0, "system", "be kind", "x"), (1, 1, "ann", "hi", None), (1, 2, "bob", "hello 😀", None),
    (1, 3, "ann", None, None), (1, 3, "ann", None, None), (1, None, "cat", "late", None), (1, 2, None, "who?", None),
    (2, 0, "ann", "alone", None), (None, 5, "bob", "no number", None), (3, 0, "system", "nobody", None),
    (4, None, None, None, None),
]


def rendered(rows):
    """Plain rendering: {(conversation, assistant): (text, learnt pieces)}."""
    found = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            [(r[1] is None, r[1] or 0, r[2] or "", r[2], r[3] or "") for r in rows if r[0] == conv],
            key=lambda r: (r[0], r[1], r[3] is None, r[2]),
        )
        for who in {r[3] for r in own} - {None, "system"}:
            text, learnt = "", []
            for _, _, _, role, said in own:
                head = {"system": "system", who: "assistant", None: "user"}.get(role, f"user name={role}")
                text += f"<|im_start|>{head}\n{said}<|im_end|>\n"
                if role == who:
                    learnt.append(f"{said}<|im_end|>\n")
            found[conv, who] = (text, learnt)
    return found


def test_rotation(rows):
    found = chat.rotated(rows(TURNS, *TALK)).collect()
    wanted = rendered(TALK)
    assert {(r["conv_id"], r["assistant"]): r["text"] for r in found} == {k: v[0] for k, v in wanted.items()}
    for r in found:
        learnt = [r["text"][s["start"] : s["start"] + s["length"]] for s in r["spans"]]
        assert learnt == wanted[r["conv_id"], r["assistant"]][1]


def test_long_conversations_have_blocks(rows):
    talk = [(1, k, f"p{k % 3}", f"message {k} " * 5, None) for k in range(400)]
    found = chat.rotated(rows(TURNS, *talk), block_chars=5_000).collect()
    wanted = rendered(talk)
    for who in ("p0", "p1", "p2"):
        blocks = sorted((r for r in found if r["assistant"] == who), key=lambda r: r["block"])
        assert len(blocks) > 10 and [b["block"] for b in blocks] == list(range(len(blocks)))
        assert "".join(b["text"] for b in blocks) == wanted[1, who][0]
        assert sum(len(b["spans"]) for b in blocks) == len(wanted[1, who][1])


def test_repeats_are_rendered_as_often_as_they_come(rows):
    talk = [(1, None, "ann", "ok", None)] * 50 + [(1, None, "bob", "ok", None)] * 3 + [(1, 1, "ann", "ok", None)] * 2
    wanted = rendered(talk)
    for block_chars in (1 << 18, 1_000):
        found = chat.rotated(rows(TURNS, *talk), block_chars=block_chars).collect()
        for who, own in (("ann", 52), ("bob", 3)):
            blocks = sorted((r for r in found if r["assistant"] == who), key=lambda r: r["block"])
            assert "".join(b["text"] for b in blocks) == wanted[1, who][0]
            assert sum(b["n_messages"] for b in blocks) == 55 and sum(len(b["spans"]) for b in blocks) == own


def test_other_columns_and_names_of_its_own(rows):
    names = "before, block, hash, times, repeat, conversation, number, speaker, message, own, header, assistant, spans"
    wide = TURNS + "".join(f", {n} string" for n in names.split(", "))
    found = chat.rotated(rows(wide, *[(*t, *["x"] * 13) for t in TALK])).collect()
    assert {(r["conv_id"], r["assistant"]): r["text"] for r in found} == {k: v[0] for k, v in rendered(TALK).items()}


def test_no_conversations(rows):
    assert chat.rotated(rows(TURNS, *TALK).where("false")).collect() == []


@pytest.mark.parametrize("name", ["op1_mix_sources", "op3_perspective_rotation", "op9_warc_derivatives"])
def test_query_equals_sql(spark, duck, name):
    duck.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    found = QUERIES[name](spark, FOLDER)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(found.columns)
    wanted = sorted(map(str, expected.fetchall()))
    assert sorted(str(tuple(r[c] for c in columns)) for r in found.collect()) == wanted and wanted


@pytest.mark.parametrize("name", ["op3_perspective_rotation", "op9_warc_derivatives"])
def test_no_python_on_the_way(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("MapInArrow|MapInPandas|EvalPython|PythonUDF|InPandas", plan)


RECORDS = "record_id string, target_uri string, date string, block string, label string"


def response(body, kind="text/html", status="200 OK"):
    return f"HTTP/1.1 {status}\r\nServer: x\r\nContent-Type: {kind}\r\nX: a\r\nX: b\r\n\r\n{body}"


def test_derivatives(rows):
    page = '<html lang="en"><head><title> A  b </title></head><body><a href="/1">one</a><p>t&amp;u</p><a class=c href=\'/2\'>2</a></body></html>'
    given = [
        ("<r1>", "http://a/", "2024", response(page), "x"),
        ("<r2>", None, None, response("plain\n\ntext", "text/plain; charset=utf-8"), None),
        ("<r3>", "http://c/", "2024", response("%PDF", "application/pdf"), None),
        ("<r4>", "http://d/", "2024", response(page, status="404 Not Found"), None),
        (None, None, None, None, None),
        ("<r5>", "http://e/", "2024", "HTTP/1.1 200 OK\r\nContent-Type: text/html", None),
        ("<r1>", "http://a/", "2024", response(page), "x"),
    ]
    found = warc.derive(rows(RECORDS, *given)).collect()
    by = {(r["refers_to"], r["warc_type"]): r for r in found}
    assert len(found) == 7 + 4 and len([r for r in found if r["refers_to"] == "<r1>"]) == 4
    assert set(by) == {(i, "metadata") for i in ("<r1>", "<r2>", "<r3>", "<r4>", "<r5>", None)} | {
        (i, "conversion") for i in ("<r1>", "<r2>", "<r5>")
    }
    assert by["<r1>", "conversion"]["block"] == "one t&u 2"
    assert by["<r2>", "conversion"]["block"] == "plain\n\ntext"
    assert by["<r5>", "conversion"]["block"] == ""
    meta = by["<r1>", "metadata"]
    assert meta["source_headers"] == ["Server: x", "Content-Type: text/html", "X: a", "X: b"]
    assert meta["block"].split("\r\n")[-6:] == ["source-header: X: b", "title: A b", "language: en", "outlink: /1", "outlink: /2", ""]
    assert (by["<r4>", "metadata"]["source_status"], by[None, "metadata"]["source_status"]) == (404, None)
    for r in found:
        raw = r["block"].encode()
        assert r["content_length"] == len(raw) and r["block_digest"] == "sha256:" + hashlib.sha256(raw).hexdigest()
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-3[0-9a-f]{3}-8[0-9a-f]{3}-[0-9a-f]{12}>", r["record_id"])
    assert meta["payload_digest"] == "sha256:" + hashlib.sha256(page.encode()).hexdigest()


def test_files_hold_whole_records(spark, rows, tmp_path):
    given = [("<r1>", "http://a/", "2024", response("<p>é\r\n\r\nb</p>"), None), ("<r2>", None, "2024", response("x", "text/plain"), None)]
    records = warc.derive(rows(RECORDS, *given))
    warc.write_warc(records.coalesce(1), str(tmp_path / "warc"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "warc").glob("part-*")))
    read = []
    while raw:  # by the format: header lines, empty line, as many bytes as announced, two line ends
        head, raw = raw.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        read.append((fields["WARC-Type"], fields["WARC-Refers-To"], fields.get("WARC-Target-URI"), raw[:length].decode()))
        assert raw[length : length + 4] == b"\r\n\r\n"
        raw = raw[length + 4 :]
    wanted = [(r["warc_type"], r["refers_to"], r["target_uri"], r["block"]) for r in records.collect()]
    assert sorted(map(str, read)) == sorted(map(str, wanted))


def test_responses_of_odd_pages(rows):
    pages = rows("page_id long, url string, html string, block string", (1, None, None, "x"), (None, "u", "", None), (2, "u", "é", "y"))
    found = warc.responses(pages).collect()
    assert [r["block"].split("\r\n\r\n", 1)[1] for r in found] == ["", "", "é"]
    assert "Content-Length: 2" in found[2]["block"] and len({r["record_id"] for r in found}) == 3
    assert warc.derive(warc.responses(pages.where("false"))).collect() == []
    assert warc.derive(warc.responses(pages)).agg(F.count("block")).first()[0] == 6
