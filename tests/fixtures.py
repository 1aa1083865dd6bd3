"""Hand-written shop pages for the two layouts (no captured data).

Each builder returns HTML; ``site_a_pages`` / ``site_b_pages`` return rows
``(page_id, url, html, fetched_at, site, page_type)`` for a small walk.
"""

from __future__ import annotations

from datetime import datetime, timedelta

T0 = datetime(2024, 3, 1, 8, 0, 0)
HOST_A = "http://shop-a.example"
HOST_B = "http://shop-b.example"
LINK_HOST_B = "https://web.shop-b.example"


def a_product(title="可口 汽水 500ml x 20", cate="飲品 Drinks", brand="可口 ", new="HKD128.00",
              old="HKD135.00", discounts=(), desc="http://img/desc.jpg", image="http://img/p 1.jpg",
              crumbs=None, error=False, class_order="product-info split-60-40"):
    if error:
        return '<html><body><div id="content"><h1>Product not found!</h1></div></body></html>'
    crumbs = crumbs if crumbs is not None else ["Home", cate]
    crumb_html = " &gt; ".join(f'<a href="#"><span itemprop="title">{c}</span></a>' for c in crumbs)
    brand_html = f'<div class="description"><a href="/brand">{brand}</a> Brand</div>' if brand is not None \
        else '<div class="description">No brand</div>'
    disc_html = "".join(f'<div class="discount">{d}</div>' for d in discounts)
    desc_html = f'<div id="tab-description"><p><img src="{desc}"></p></div>' if desc else \
        '<div id="tab-description"><p>text only</p></div>'
    image_html = f'<a href="{image}" title="{title}"><img src="thumb.jpg"></a>' if image else ""
    if title is None:
        image_html = f'<a href="{image}"><img src="thumb.jpg"></a>'
    price_html = ""
    if new is not None:
        price_html += f'<span class="price-new">{new}</span>'
    if old is not None:
        price_html += f'<span class="price-old">{old}</span>'
    return f"""<html><head><title>t</title></head><body>
<div class="breadcrumb">{crumb_html}</div>
<div id="content">
 <div class="{class_order}">
  <div class="left"><div class="image">{image_html}</div></div>
  <div class="right"><div class="product-options">
   {brand_html}
   <div class="price">{price_html}</div>
   {disc_html}
  </div></div>
 </div>
 {desc_html}
</div></body></html>"""


def a_home(links):
    lis = "".join(f'<li><a href="{u}">c{i}</a></li>' for i, u in enumerate(links))
    return f'<html><body><div class="box-category"><ul>{lis}</ul></div></body></html>'


def a_pagination(last_href=None):
    inner = '<div class="links"><a href="x?page=2">2</a>'
    if last_href:
        inner += f'<a href="{last_href}">&gt;|</a>'
    inner += "</div>"
    return f'<html><body><div class="pagination">{inner}</div></body></html>'


def a_listing(product_urls):
    items = "".join(f'<div class="product-list-item"><div><a href="{u}">p</a></div></div>'
                    for u in product_urls)
    return f"<html><body>{items}</body></html>"


def b_product(itemno_url_name="Rose Cream", brand="BrandX", cate_links=(("Skin", "10"), ("Face Cream", "12")),
              image="/img/b1.jpg", price_big="HKD99.50", lines=("specification: 50ml ", "RRP: HKD120"),
              desc=("Line one", "Line two"), name_spans=("Rose Cream",)):
    loc = '<a href="/">Home</a>'
    if brand is not None:
        loc += f'<a href="/brand?b=1">{brand}</a>'
    for text, code in cate_links:
        loc += f'<a href="/cate/list?categoryId={code}">{text}</a>'
    img = f'<div><img src="{image}"></div>' if image else "<div>no image</div>"
    spans = "".join(f"<span>{s}</span>" for s in name_spans)
    content = "".join(f"<div>{ln}</div>" for ln in lines)
    if price_big is not None:
        content += f"<div>Price: <big>{price_big}</big></div>"
    ps = "".join(f"<p>{p}</p>" for p in desc)
    return f"""<html><body>
<div class="margin">
 <div class="location">{loc}</div>
 <div class="detail-info mt-10">
  <div class="left">{img}</div>
  <div class="right">
   <div class="title"><a href="#">{spans}</a></div>
   <div class="content">{content}</div>
  </div>
 </div>
</div>
<div id="Detail"><div class="right"><div class="detail-item" id="chapter-2"><div class="content">{ps}</div></div></div></div>
</body></html>"""


def b_home(hrefs):
    items = "".join(f'<div class="category_expand_item"><a href="{h}">c</a></div>' for h in hrefs)
    return f"<html><body>{items}</body></html>"


def b_subcategory(hrefs):
    dts = "".join(f'<dt><a href="{h}">s</a></dt>' for h in hrefs)
    return f'<html><body><div class="box_catalog"><div class="content"><dl>{dts}</dl></div></div></body></html>'


def b_pagination(links):
    anchors = "".join(f'<a href="{h}">{t}</a>' for h, t in links)
    return f'<html><body><div class="pages">{anchors}</div></body></html>'


def b_listing(items):
    lis = ""
    for it in items:
        if isinstance(it, tuple):
            lis += f'<li><a href="{it[0]}">img</a><a href="{it[1]}">name</a></li>'
        else:
            lis += f'<li><a href="{it}">only</a></li>'
    return f'<html><body><div class="box_list"><ul>{lis}</ul></div></body></html>'


def _rows(site, pages):
    return [(i + 1, url, html, T0 + timedelta(seconds=i), site, ptype)
            for i, (url, html, ptype) in enumerate(pages)]


def site_a_pages():
    """Home -> 2 categories (first link skipped) -> pages -> lists -> products."""
    cat1 = f"{HOST_A}/index.php?route=product/category&path=1"
    cat2 = f"{HOST_A}/index.php?route=product/category&path=2"
    pid = lambda n: f"{HOST_A}/index.php?route=product/product&path=1&product_id={n}"
    pages = [
        (f"{HOST_A}/", a_home([f"{HOST_A}/skip", cat1, cat2]), "home"),
        (cat1, a_pagination(f"{cat1}&page=3"), "pagination"),
        (cat2, a_pagination(None), "pagination"),
        (f"{cat1}&page=1", a_listing([pid(1), pid(2)]), "listing"),
        (f"{cat1}&page=2", a_listing([pid(3), pid(1)]), "listing"),
        (f"{cat1}&page=3", a_listing([pid(4)]), "listing"),
        (f"{cat2}&page=1", a_listing([pid(5), pid(6), pid(7)]), "listing"),
        (pid(1), a_product(discounts=["6 or more HKD120.00", "  ", "12 or more HKD110.00"]), "product"),
        (pid(2), a_product(title="Cola 330mlx24", cate="NEW", brand=None, desc=None), "product"),
        (pid(3), a_product(error=True), "product"),
        (pid(4), a_product(discounts=["6 or more"]), "product"),
        (pid(5), a_product(cate="123"), "product"),
        (pid(6), a_product(title="Tea 500ml x 6", old=None), "product"),
        (pid(7), a_product(title="水 1.25L x 12", class_order="split-60-40 product-info"), "product"),
    ]
    return _rows("A", pages)


def site_b_pages():
    sub = f"{LINK_HOST_B}/sub?c=1"
    item = lambda n: f"{LINK_HOST_B}/product/detail?itemno={n}"
    pages = [
        (f"{HOST_B}/home", b_home(["/cat?c=1"]), "home"),
        (f"{HOST_B}/cat?c=1", b_subcategory(["/sub?c=1"]), "subcategory"),
        (sub, b_pagination([("/sub?c=1&page=2", "2"), ("/sub?c=1&page=3", ""), ("/sub?c=1&page=4", "Next")]),
         "pagination"),
        (f"{sub}&page=1", b_listing([("/product/detail?itemno=101x", "/product/detail?itemno=101"),
                                     "/product/detail?itemno=999"]), "listing"),
        (f"{sub}&page=2", b_listing([("/i", "/product/detail?itemno=102"),
                                     ("/i", "/product/detail?itemno=103")]), "listing"),
        (item(101), b_product(), "product"),
        (item(102), b_product(brand=None, lines=("specification: 30ml", " RRP: HKD10", "colour: red",
                                                  "colour：blue"), price_big="HKD45"), "product"),
        (item(103), b_product(cate_links=(("Skin", "10"), ("", "12"))), "product"),
    ]
    return _rows("B", pages)
