"""Links that stand in a page's JSON state or in captured JSON bodies."""

from brewlens.operators import menu as MN

STATE = '<script>window.{name} = {json};</script>'
PAGES = [
    (1, STATE.format(name="__INITIAL_STATE__", json='{"a":[{"u":"\\/menu\\/product\\/late"}]}')
     + STATE.format(name="__BOOTSTRAP", json='{"x":{"y":"\\/menu\\/product\\/first","z":"\\/menu\\/product\\/also"}}')),
    (2, STATE.format(name="__APOLLO_STATE__", json='{"a":"no link"}') + STATE.format(name="__PRELOADED_STATE__", json="{broken")),
    (3, '<a href="/menu/product/anchor">x</a>' + STATE.format(name="__BOOTSTRAP", json='{"x":"\\/menu\\/product\\/state"}')),
    (4, None), (5, ""), (6, "<p>nothing</p>")]
BODIES = [(2, "application/json", '{"u":"/menu/product/body"}'), (2, "application/json; charset=utf-8", '["/en/menu/hot/latte"]'),
          (3, "application/json", '"/menu/product/unused"'), (5, "text/html", '"/menu/product/html"'), (6, None, "x"),
          (6, "application/json", None)]


def test_sources_are_asked_in_order(spark):
    pages = spark.createDataFrame([(i, "https://s.example", h) for i, h in PAGES], "page_id long, url string, html string")
    bodies = spark.createDataFrame(BODIES, "page_id long, mime_type string, body string")
    alone = {r["page_id"]: r["product_links"] for r in MN.menu_links(pages).collect()}
    assert alone[1] == ["/menu/product/also", "/menu/product/first"] and alone[3] == ["/menu/product/anchor"]
    assert not alone[2] and not alone[5] and not alone[6]
    got = {r["page_id"]: (r["product_links"], r["item_links"]) for r in MN.menu_links(pages, bodies=bodies).collect()}
    assert got[2] == (["/menu/product/body"], ["/en/menu/hot/latte"]) and got[3][0] == ["/menu/product/anchor"]
    assert got[1][0] == alone[1] and not got[5][0] and not got[6][0] and len(got) == 6
