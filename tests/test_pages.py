"""Queries over pages: each page counts, whatever is on it."""

from orchardflow.plans import queries


def pages(spark, tmp_path, texts):
    rows = [(i, f"http://h{i % 3}.test/{i}", x) for i, x in enumerate(texts)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_titles_of_all_pages(spark, tmp_path):
    texts = ["<head><title>a</title></head>", "<p>none</p>", "<head><title></title></head>", "<head><title>b</title><title></title></head>"]
    got = sorted(tuple(r) for r in queries.page_title(spark, pages(spark, tmp_path, texts)).select("page_id", "has_title", "pages").collect())
    assert got == [(0, True, 4), (1, False, 4), (2, False, 4), (3, True, 4)]


def test_few_pages_are_held_at_once():
    import pyarrow as pa

    from orchardflow.operators import extract

    batch = pa.RecordBatch.from_pydict({"n": list(range(1000))})
    pieces = list(extract.few(iter([batch, batch.slice(0, 0), batch.slice(5, 1)])))
    assert max(p.num_rows for p in pieces) <= extract.FEW and [x for p in pieces for x in p.column(0).to_pylist()] == [*range(1000), 5]


def test_a_record_is_walked_once_for_all_its_fields(monkeypatch):
    from orchardflow.operators.extract import PageReader
    from orchardflow.sources.config import Mapping, Source
    from orchardflow.sources.css import Element

    walked, walk = [], Element.walk
    monkeypatch.setattr(Element, "walk", lambda e: walked.append(e.name) or walk(e))
    fields = {"title": Mapping("h2 a"), "url": Mapping("h2 > a", "href"), "sku": Mapping("b.x.y, *.z"), "price": Mapping("p.none"), "rating": Mapping("h2 a", "class")}
    html = '<ul><li><b class=x>no</b><b class="y x">S1</b><h2><a href=/p/1 class=" five  stars ">One</a></h2><li><i class=z>S2</i><h2><i><a>Two</a></i></h2></ul>'
    found, _ = PageReader(Source("s", "http://s.test", "ul > li", fields)).read(html, "http://s.test")
    assert found == [{"title": "One", "url": "/p/1", "sku": "S1", "price": None, "rating": "five stars"}, {"title": "Two", "url": None, "sku": "S2", "price": None, "rating": None}]
    assert walked.count("li") == 2
