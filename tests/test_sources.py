"""Feed files, archive files, the Python data source and the registry."""

import json

import pytest

from wiremere import schemas
from wiremere.operators import feeds
from wiremere.sources import archive, registry
from wiremere.sources import feeds as feed_files

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"
     xmlns:dc="http://purl.org/dc/elements/1.1/">
<channel><title>Daily Wire</title><link>http://daily</link>
<image><title>Logo</title></image>
<item><title>First</title><link>http://daily/1</link><description>short one</description>
  <content:encoded>the long one</content:encoded><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate>
  <category>cat</category><category>bond</category><dc:creator>A. Writer</dc:creator></item>
<item><title>Second</title><link>http://daily/2</link></item>
<item><title>First again</title><link>http://daily/1</link><description>copy</description></item>
<item><link>http://daily/3</link><description>no title, Cat Bond</description></item>
</channel></rss>"""

ATOM = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom Wire</title>
<entry><title>One</title><link rel="self" href="http://atom/self"/><link href="http://atom/1"/>
  <summary>sum</summary><content>body</content><published>2024-01-02</published>
  <category term="ils"/><author><name>B. Writer</name></author></entry>
<entry><title>Two</title><link rel="alternate" href="http://atom/2"/><summary>sum two</summary></entry>
</feed>"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "rss").mkdir()
    (tmp_path / "atom").mkdir()
    (tmp_path / "rss" / "daily.xml").write_text(RSS)
    (tmp_path / "rss" / "plain.xml").write_text(RSS.replace("<title>Daily Wire</title>", "").replace("daily/", "plain/"))
    (tmp_path / "atom" / "one.xml").write_text(ATOM)
    return tmp_path


def listed(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_rss_entries(spark, folder):
    entries = feed_files.read_entries(spark, str(folder / "rss" / "daily.xml"))
    assert entries.schema.names == [*schemas.FEED_ENTRY.names, "feed_rank", "malformed"]
    rows = {r["title"]: r for r in entries.collect()}
    first = rows["First"]
    assert (first["feed_title"], first["link"], first["content"]) == ("Daily Wire", "http://daily/1", "the long one")
    assert (first["tags"], first["authors"]) == (["cat", "bond"], ["A. Writer"])
    assert rows["Second"]["summary"] is None and rows["Second"]["tags"] is None
    order = sorted(rows.values(), key=lambda r: r["pos"])
    assert [r["title"] for r in order] == ["First", "Second", "First again", None]


@pytest.mark.parametrize("reader", ["rss", "wire"])
def test_rss_articles(spark, folder, reader):
    path = str(folder / "rss" / "daily.xml")
    options = {"paths": path} if reader == "rss" else {"path": path}
    articles = registry.source(spark, reader, **options)
    assert listed(articles, "title", "source_name", "raw_text") == [
        ("First", "rss::Daily Wire", "the long one"),
        ("Second", "rss::Daily Wire", "Second"),
        ("Untitled", "rss::Daily Wire", "no title, Cat Bond"),
    ]
    blob = json.loads(articles.filter("title = 'First'").first()["raw_metadata"])
    assert blob["feed_title"] == "Daily Wire" and blob["tags"] == ["cat", "bond"]
    assert blob["authors"] == ["A. Writer"] and blob["published"].startswith("Mon, 01 Jan 2024")
    assert blob["feed_url"].endswith("daily.xml")


def test_feed_without_title_is_named_by_its_url(spark, folder):
    articles = registry.source(spark, "RSS", paths=str(folder / "rss"))
    names = {r["source_name"] for r in articles.collect()}
    assert "rss::Daily Wire" in names
    assert any(n.startswith("rss::file:") and n.endswith("plain.xml") for n in names)
    assert articles.count() == 6


def test_cap_comes_before_dedup_and_dedup_before_keyword(spark, folder):
    read = lambda **kw: listed(registry.source(spark, "rss", paths=str(folder / "rss" / "daily.xml"), **kw), "title")
    assert read(max_entries=1) == [("First",)]
    assert read(max_entries=3) == [("First",), ("Second",)]
    assert read(query="cat bond") == [("Untitled",)]
    assert read(query="again") == [], "the dropped copy does not come back through the filter"
    assert read(query="long one") == [], "the keyword looks at title and summary, not content"


def test_atom(spark, folder):
    entries = feed_files.read_entries(spark, str(folder / "atom"), "atom")
    assert listed(entries, "title", "feed_title", "link", "summary", "content") == [
        ("One", "Atom Wire", "http://atom/1", "sum", "body"),
        ("Two", "Atom Wire", "http://atom/2", "sum two", None),
    ]
    one = entries.filter("title = 'One'").first()
    assert (one["tags"], one["authors"], one["published"]) == (["ils"], ["B. Writer"], "2024-01-02")


def test_wire_reads_both_kinds_alike(spark, folder):
    columns = ["title", "source_name", "source_url", "raw_text", "raw_metadata"]
    both = registry.source(spark, "wire", path=[str(folder / "rss"), str(folder / "atom")])
    rss = registry.source(spark, "rss", paths=str(folder / "rss"))
    atom = registry.source(spark, "rss", paths=str(folder / "atom"), kind="atom")
    assert listed(both, *columns) == sorted(listed(rss, *columns) + listed(atom, *columns))


NESTED = """<rss><channel><title>N</title>
<item><link>http://n/1</link><description>Hello <b>bold</b> tail</description><author>two</author></item>
<item><guid>nothing said</guid></item>
<item><title>  </title><link>http://n/2</link><description> </description></item>
</channel></rss>"""


def test_nothing_is_invented_and_nothing_lost(spark, tmp_path):
    (tmp_path / "nested.xml").write_text(NESTED)
    (tmp_path / "broken.xml").write_text(RSS[: RSS.index("<description>copy")])
    found = registry.find("rss")(spark, paths=str(tmp_path))
    good = feeds.accepted(found)
    assert listed(good, "source_url", "raw_text") == [
        ("http://daily/1", "the long one"),
        ("http://daily/2", "Second"),
        ("http://n/1", "Hello <b>bold</b> tail"),
    ]
    nested = json.loads(good.filter("source_url = 'http://n/1'").first()["raw_metadata"])
    assert nested["authors"] == ["two"]
    bad = sorted((r["reject_reason"], r["raw_text"] or "") for r in feeds.rejected(found).collect())
    assert [reason for reason, _ in bad] == [feeds.EMPTY, feeds.MALFORMED, "raw_text is empty"]
    assert "First again" in bad[1][1]


def test_a_missing_feed_costs_the_others_nothing(spark, folder):
    paths = [str(folder / "none.xml"), str(folder / "rss" / "plain.xml"), str(folder / "no" / "*.xml")]
    assert registry.source(spark, "rss", paths=paths).count() == 3
    assert registry.source(spark, "rss", paths=paths[0]).count() == 0


def test_the_feed_given_first_wins_a_copy(spark, tmp_path):
    for name in ("a", "b"):
        item = f"<item><link>http://same</link><description>{name}</description></item>"
        (tmp_path / f"{name}.xml").write_text(f"<rss><channel><title>{name}</title>{item}</channel></rss>")
    for first, second in ("ab", "ba"):
        paths = [str(tmp_path / f"{n}.xml") for n in (first, second)]
        assert listed(registry.source(spark, "rss", paths=paths), "raw_text") == [(first,)]


def test_a_long_feed_is_read_whole(spark, tmp_path):
    items = "".join(f"<item><link>http://l/{i}</link><title>t</title></item>" for i in range(2500))
    (tmp_path / "long.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    path = str(tmp_path / "long.xml")
    assert registry.source(spark, "rss", paths=path).count() == 2500
    assert registry.source(spark, "rss", paths=path, max_entries=1500).count() == 1500


DOCS = [
    {"ResultUrl": "http://a/1", "Title": "Cat bond", "Date": "2024-01-05", "DocumentType": "News",
     "Source": {"Id": "s1", "Name": "One"}, "Document": {"Content": "text one"}},
    {"ResultUrl": "http://a/2", "Title": "Other", "Date": "2024-02-05T10:00:00", "Source": {"Id": "s2"},
     "Document": {"Content": "text CAT BOND"}},
    {"ResultUrl": "http://a/3", "Title": "No content", "Date": "2024-01-07", "Source": {"Id": "s1"}},
]


@pytest.fixture
def archive_file(tmp_path):
    path = tmp_path / "docs.json"
    path.write_text("\n".join(map(json.dumps, DOCS)))
    return str(path)


def test_archive_articles(spark, archive_file):
    articles = registry.source(spark, "archive", paths=archive_file)
    assert listed(articles, "source_name", "source_url", "raw_text") == [
        ("archive", "http://a/1", "text one"),
        ("archive", "http://a/2", "text CAT BOND"),
    ], "a document without content breaks the contract"
    blob = json.loads(articles.filter("title = 'Other'").first()["raw_metadata"])
    assert blob == {"source_id": "s2", "source_name": None, "published_date": "2024-02-05T10:00:00", "document_type": None}


@pytest.mark.parametrize(
    ("options", "urls"),
    [
        ({"date_from": "2024-01-06"}, ["2"]),
        ({"date_to": "2024-02-05"}, ["1", "2"]),
        ({"date_to": "2024-01-31"}, ["1"]),
        ({"sources": ["s2"]}, ["2"]),
        ({"query": "cat bond"}, ["1", "2"]),
        ({"max_results": 1}, ["1"]),
        ({"sources": []}, []),
    ],
)
def test_archive_filters(spark, archive_file, options, urls):
    found = feeds.accepted(archive.read_archive(spark, archive_file, **options))
    assert [u.rsplit("/", 1)[1] for (u,) in listed(found, "source_url")] == urls


def test_registry(spark, frame):
    with pytest.raises(KeyError, match="unknown source 'bloom'.*archive.*rss.*wire"):
        registry.source(spark, "bloom")
    mine = frame("source_name string, raw_text string", [("x", "t")])
    registry.register("Mine", lambda spark, n: mine.limit(n))
    try:
        assert registry.source(spark, "MINE", n=1).count() == 1
    finally:
        registry.SOURCES.pop("mine")


def test_union_matches_columns_by_name(frame):
    a, b = frame("x string, y string", [("1", "2")]), frame("y string, x string", [("2", "1")])
    assert feeds.union_sources(a, b).distinct().count() == 1


def test_seen_keys_of_earlier_runs(frame):
    rows = [("f", 1, "http://a", "t"), ("f", 2, "http://b", "t"), ("f", 3, None, "t"), ("f", 4, "", "t")]
    entries = frame("feed_url string, pos bigint, link string, title string", rows)
    seen = frame("dedup_key string", [("http://b",)])
    assert [r["pos"] for r in feeds.drop_repeats(entries, seen).orderBy("pos").collect()] == [1, 3]
