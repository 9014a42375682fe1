"""The URL model on hosts that it never saw, odd urls, and long keys."""

import duckdb
import pytest

from riskframe.llm import pii, url_filter

#: No host of these stands in the labelled table.
APART_BLOCKED = (
    "https://m.casino-win.example.org/en/3", "http://grand-casino.example.net/", "http://casino.example.org/de/88", "https://free-bets.example.org/en/1",
    "http://live-bets.example.net/odds", "https://blog.spam-farm.example.org/en/12", "http://spam.example.net/fr/4", "https://ads-track.example.org/en/77",
    "http://www.ads-track.example.net/click", "https://m.adult-x.example.net/en/9", "http://adult-films.example.org/", "https://pills.example.org/order",
    "http://poker-win.example.net/table", "https://fast-loans.example.org/apply", "http://warez-crack.example.net/", "https://xxx-live.example.org/de/2",
    "http://royal-bets.example.org/es/5", "https://www.spam-post.example.net/en/9", "http://m.ads-farm.example.org/", "https://casino-night.example.net/fr/71",
    "http://adult-shop.example.org/en/2", "https://pills-now.example.net/de/1")
APART_ALLOWED = (
    "https://blog.tionsh.example.org/en/836", "http://www.ththon.example.org/en/8269.html", "https://m.therer.example.org/en/8055?page=2&ref=x",
    "http://ththti.example.net/de/47", "https://therat.example.net/en/5", "https://www.orchard.example.org/en/19", "http://m.violin.example.net/fr/61/",
    "https://harbour.example.org/en/204", "http://blog.old-town.example.net/de/3", "https://astronomy.example.org/stars", "http://www.chess-club.example.net/en/9",
    "https://m.mountains.example.org/es/410", "http://parliament.example.org/acts/7", "https://pottery.example.net/en/55.html", "http://bridge-days.example.org/en/1",
    "https://www.railways.example.net/de/730", "http://lighthouse.example.org/en/33", "https://blog.cheese-maker.example.net/fr/12", "http://m.swimming.example.org/de/4",
    "https://poems.example.net/es/18", "http://www.winter-birds.example.org/en/700?page=2", "https://clocks.example.org/repair")


def _verdicts(spark, urls):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    return {r.page_id: r for r in url_filter.judge_urls(frame).collect()}


def test_unseen_hosts(spark):
    known = {u.split("://")[1].split("/")[0] for u in url_filter.BLOCKED + url_filter.ALLOWED}
    assert not known & {u.split("://")[1].split("/")[0] for u in APART_BLOCKED + APART_ALLOWED}
    urls = APART_BLOCKED + APART_ALLOWED
    got = _verdicts(spark, urls)
    score = [got[i].block_score > url_filter.BLOCK_AT for i in range(len(urls))]
    right = sum(score[:len(APART_BLOCKED)]), sum(not s for s in score[len(APART_BLOCKED):])
    print(f"unseen hosts: {right[0]} of {len(APART_BLOCKED)} blocked, {right[1]} of {len(APART_ALLOWED)} allowed")
    assert right[0] >= 0.9 * len(APART_BLOCKED) and right[1] >= 0.85 * len(APART_ALLOWED)


def test_the_labelled_table_names_no_supplied_host():
    hosts = {r[0] for r in duckdb.sql(
        "SELECT DISTINCT lower(regexp_extract(url, '://([^/?#]*)', 1)) FROM '/root/testdata/sf0.1/pages.parquet'").fetchall()}
    assert not hosts & {u.split("://")[1].split("/")[0] for u in url_filter.BLOCKED + url_filter.ALLOWED}


@pytest.mark.parametrize("url, host, path", [
    ("", "", ""), (None, "", ""), ("no scheme", "", ""), ("http://", "", ""), ("x://A.B", "a.b", ""), ("http://H/" + "p" * 50000 + "?q", "h", "/" + "p" * 50000),
    ("a://b://c/d", "b:", "//c/d"), ("http://É.COM/ä#x", "É.com", "/ä"), ("http://h\nost/p", "h\nost", "/p")])
def test_odd_urls(spark, url, host, path):
    got = _verdicts(spark, [url, url])
    assert [(r.host, r.path) for r in got.values()] == [(host, path)] * 2 and got[0].verdict == got[1].verdict


def test_secrets_of_any_length_and_case(spark):
    lower, upper = "0123456789abcdef" * 8, "0123456789ABCDEF" * 2
    texts = [f"key {lower} end", f"token: {upper}", "digits " + "1234567890" * 5, "Mixed " + "0123456789abCDEF" * 2, f"x{lower}", "key " + "0a" * 15, "key " + "0a" * 16]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {r.doc_id: r.spans for r in rows}
    assert f"secret:4:{4 + 128}" in spans[0] and f"secret:7:{7 + 32}" in spans[1] and "secret:4:36" in spans[6]
    assert not any("secret" in spans[i] for i in (2, 3, 4, 5))
