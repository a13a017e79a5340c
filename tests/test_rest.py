"""Paged services: a server of this test that pages by offset, by token in the request, and by token in a posted body."""

import http.server
import json
import threading
import urllib.parse

import pytest

from tidewatch.sources import rest

ROWS = [{"name": f"n{i}", "size": i, "kind": "odd" if i % 2 else "even"} for i in range(95)]


@pytest.fixture(scope="module")
def server():
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url = urllib.parse.urlparse(self.path)
            self.answer(url.path, {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()})

        def do_POST(self):
            self.answer(self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"]))))

        def answer(self, path, given):
            asked.append((path, given))
            rows = [r for r in ROWS if given.get("kind") in (None, r["kind"])]
            if path == "/flaky" and sum(p == "/flaky" for p, _ in asked) < 3:
                return self.send_error(503)
            if path in ("/offsets", "/flaky"):
                at = int(given["$skip"])
                out = {"Items": rows[at : at + 10]}
            else:
                token = given.get("NextToken") or given.get("options", {}).get("$skipToken") or "0"
                at = int(token)
                out = {"data": {"list": rows[at : at + 10]}} | ({"NextToken": str(at + 10), "$skipToken": str(at + 10)} if at + 10 < len(rows) else {})
            body = json.dumps(out).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        yield f"http://127.0.0.1:{s.server_port}", asked
        s.shutdown()


def read(spark, **options):
    rest.register(spark)
    return spark.read.format("paged_json").schema("name string, size long, kind string").options(**options).load()


def test_offsets_until_a_page_is_empty(spark, server):
    got = read(spark, url=server[0] + "/offsets", size=10, strands=3)
    assert got.rdd.getNumPartitions() == 3
    assert sorted(r.size for r in got.collect()) == list(range(95))


def test_known_number_of_pages(spark, server):
    assert sorted(r.size for r in read(spark, url=server[0] + "/offsets", size=10, pages=4).collect()) == list(range(40))


def test_tokens_in_the_request(spark, server):
    got = read(spark, url=server[0] + "/tokens", token="NextToken", records="data.list", filters="kind").where("kind = 'odd'")
    assert [r.size for r in got.collect()] == list(range(1, 95, 2))
    assert all(g.get("kind") == "odd" for p, g in server[1] if p == "/tokens")


def test_tokens_in_a_posted_body(spark, server):
    body = json.dumps({"query": "all", "options": {"$skipToken": "{token}"}})
    got = read(spark, url=server[0] + "/graph", token="$skipToken", records="data.list", body=body)
    assert [r.size for r in got.collect()] == list(range(95))


def test_answers_that_fail_are_asked_again(spark, server):
    assert read(spark, url=server[0] + "/flaky", size=10, pages=1, pause=0).count() == 10


def test_landed_pages_by_token(spark, tmp_path):
    for name, rows, following in (("", ROWS[:3], "b"), ("b", ROWS[3:5], "c"), ("c", [], None)):
        (tmp_path / f"page-{name}.json").write_text(json.dumps({"Items": rows, "next": following}))
    got = read(spark, url=f"file://{tmp_path}/page-{{token}}.json", token="next")
    assert [r.size for r in got.collect()] == list(range(5))
