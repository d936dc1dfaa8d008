"""Labelled training pages of the HTML extractor.

``data-keep`` marks the elements whose own text belongs to the article; the
extractor's features never see it.
"""

_LONG = ("The river rose two metres during the night, and by morning the lower fields were under water. "
         "Farmers moved their cattle to the hills while volunteers filled bags with sand along the main road.")
_LONG2 = ("Nobody expected the old bridge to hold, yet it carried the heavy trucks for three more days. "
          "Engineers from the county checked the pillars every hour and wrote down what they saw.")
_LONG3 = "After the storm the council met in the school, because the town hall had lost its roof."
_SHORT = "It was a long week."
_DE = "Der Fluss stieg in der Nacht um zwei Meter, und am Morgen standen die unteren Felder unter Wasser."
_FR = "La rivière est montée de deux mètres pendant la nuit, et les champs étaient inondés le matin."

_HEAD = '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>River floods the valley</title><style>p{margin:0}</style><script>track(1);</script></head><body>'
_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/sport">Sport</a></li><li><a href="/about">About us</a></li></ul></nav>'
_FOOT = "<footer>&copy; valley.example.com &middot; All rights reserved. Nothing here may be copied without a licence.</footer></body></html>"

_BASE = (
    # plain article, unclosed tags
    _HEAD + _NAV + f'<!-- ad --><div class="ad">{_LONG3}</div><article><h1 data-keep>River floods the valley</h1><p data-keep><b>{_LONG}<br><p data-keep>{_LONG2}</p><p data-keep>{_SHORT}</p></article>' + _FOOT,
    _HEAD + _NAV + f'<div class="ad">Buy now.</div><article><h1 data-keep>Of bread and salt.</h1><p data-keep>{_SHORT}</p><p data-keep>Rain.</p><p data-keep>{_LONG}</p></article>' + _FOOT,
    _HEAD + _NAV + f'<div class="ad">{_LONG}</div><article><h1 data-keep>Schwere Flut</h1><p data-keep>{_DE}</p><p data-keep><b>{_DE}<br><p data-keep>Nein.</p></article><footer>&copy; example.net &middot; {_DE}</footer></body></html>',
    # short article between long boilerplate
    _HEAD + _NAV + f'<div class="ad">{_LONG}</div><article><h1 data-keep>Note</h1><p data-keep>Fine.</p></article><footer>&copy; x &middot; {_LONG2}</footer></body></html>',
    # site header, sidebar, cookie notice
    _HEAD + f'<div class="cookie-notice" id="consent"><p>We use cookies to improve this site.</p><button>Accept</button></div><header class="site-header"><a href="/">The Valley Post</a><p>News from the valley since 1901.</p></header>{_NAV}<main><article><h1 data-keep>Bridge closed</h1><p data-keep>{_LONG2}</p><h2 data-keep>What comes next</h2><p data-keep>{_LONG3}</p></article></main><aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten ways to dry a cellar</a></li><li><a href="/2">Market prices</a></li></ul><p>{_LONG3}</p></aside>' + _FOOT,
    # comments and a form below the article
    _HEAD + _NAV + f'<article class="post"><h1 data-keep>Harvest report</h1><p data-keep>{_LONG}</p><ul><li data-keep>Wheat: good, but late.</li><li data-keep>Barley: poor in the north.</li></ul><p data-keep>{_LONG3}</p></article><section class="comments" id="comments"><h2>Comments</h2><div class="comment"><p class="author">Anna</p><p>{_LONG2}</p></div><div class="comment"><p>I saw it too, and it was worse than they say.</p></div><form action="/post"><label>Your name</label><input name="n"><textarea>Say something</textarea><button>Send</button></form></section>' + _FOOT,
    # comments inside the article element
    _HEAD + _NAV + f'<article><h1 data-keep>Night train</h1><p data-keep>{_LONG}</p><p data-keep>{_LONG2}</p><div class="share">Share this on <a href="#">Mail</a></div><div class="comments"><p>First! What a story, I read it twice.</p><p>{_LONG3}</p></div></article>' + _FOOT,
    # no article element: content div
    _HEAD + f'<div id="menu"><a href="/">Home</a> <a href="/b">Blog</a></div><div id="content"><h1 data-keep>Snow in May</h1><p data-keep>{_LONG}</p><p data-keep>{_LONG2}</p><p data-keep>{_LONG3}</p></div><div id="sidebar"><p>About the author and this site.</p><ul><li><a href="/a">Archive</a></li></ul></div><div id="footer"><p>Copyright 2020. Contact us at the office.</p></div></body></html>',
    # bare divs, text directly in them
    _HEAD + f'<div class="nav"><a href="/">Start</a><a href="/x">Links</a></div><div class="article-body"><h2 data-keep>Old mill</h2><div data-keep>{_LONG}</div><div data-keep>{_LONG2}</div></div><div class="related"><h3>Related stories</h3><a href="/1">The mill in winter</a><a href="/2">A walk to the mill</a></div><div class="footer">All rights reserved.</div></body></html>',
    # advert, newsletter and notice between the paragraphs
    _HEAD + _NAV + f'<main><h1 data-keep>Market day</h1><p data-keep>{_LONG}</p><div class="advert banner"><p>Great shoes, half the price. Only today in our shop.</p></div><p data-keep>{_LONG2}</p><div class="newsletter"><p>Subscribe to our newsletter and never miss a story.</p><form><input type="email"><button>Subscribe</button></form></div><p data-keep>{_LONG3}</p><div class="notice"><p>This page was moved. Please update your bookmarks.</p></div></main>' + _FOOT,
    _HEAD + f'<div role="banner" class="header"><h1>The Daily Note</h1><p>All that matters.</p></div><section class="content"><h2 data-keep>Quiet harbour</h2><p data-keep>{_FR}</p><blockquote><p data-keep>{_FR}</p></blockquote><p data-keep>Fin.</p></section><div class="promo"><p>{_LONG3}</p></div><footer><p>Contact, imprint, terms.</p><ul><li><a href="/t">Terms</a></li></ul></footer></body></html>',
    # article header with byline, table, pre, figure
    _HEAD + _NAV + f'<article><h1 data-keep>Prices</h1><p data-keep>{_LONG3}</p><table><tr><td data-keep>Wheat</td><td data-keep>12.50</td></tr><tr><td data-keep>Oats</td><td data-keep>9.10</td></tr></table><pre data-keep>total = 21.60</pre><figure><figcaption data-keep>The market in spring.</figcaption></figure><p data-keep>{_LONG}</p></article>' + _FOOT,
    # breadcrumbs, tags, pagination
    _HEAD + f'<div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></div><main id="main"><h1 data-keep>Hidden valley</h1><p data-keep>See the <a href="/m">map</a> of the valley, which shows every path and spring.</p><p data-keep>{_LONG2}</p><div class="tags"><a href="/t1">valley</a> <a href="/t2">spring</a></div><div class="pagination"><a href="/2">Next page</a></div></main><div class="sidebar widget"><p>{_LONG}</p></div>' + _FOOT,
    # only boilerplate
    _HEAD + _NAV + '<div class="ad">Nothing to read.</div>' + _FOOT,
    _HEAD + _NAV + f'<div class="ad">{_SHORT}</div><article><h1 data-keep>{_SHORT}</h1><p data-keep>{_LONG}</p><p data-keep>{_SHORT}</p><p data-keep>{_LONG3}</p></article><footer>&copy; m.example.org &middot; {_LONG3}</footer></body></html>',
    _HEAD + _NAV + f'<form class="search"><label>Search</label><input><button>Go</button></form><div class="notice">Please sign in to continue.</div>' + _FOOT,
    # modal and alert first, list article
    _HEAD + f'<div class="modal popup"><p>{_LONG3}</p><button>Close</button></div><div class="alert" role="alert">Service is slow today.</div>{_NAV}<article><h1 data-keep>Five rivers</h1><ol><li data-keep>{_LONG3}</li><li data-keep>The Arn, short and cold.</li><li data-keep>The Bel, wide and slow, with many islands.</li></ol><p data-keep>{_LONG}</p></article><div id="disqus_thread" class="comment-list"><p>{_LONG2}</p><p>Agreed.</p></div>' + _FOOT,
    # paragraphs straight in the body
    f'<html><body><p data-keep>{_LONG}</p><p data-keep>{_LONG2}</p><p data-keep>{_LONG3}</p></body></html>',
    f'<html><body><h1 data-keep>Plain page</h1><p data-keep>{_DE}</p><p data-keep>{_SHORT}</p><hr><div class="footer">Imprint</div></body></html>',
    _HEAD + f'<header><nav><a href="/">A</a><a href="/b">B</a></nav></header><div class="wrapper"><div class="main"><div class="post-content entry"><h1 data-keep>Wind</h1><p data-keep>{_LONG}</p><p data-keep>Yes.</p><p data-keep>{_FR}</p></div><div class="reader-comments"><h4>Readers wrote</h4><p>{_FR}</p><p>{_LONG}</p></div></div><div class="side"><p>Weather: rain, {_LONG3}</p></div></div>' + _FOOT,
    _HEAD + _NAV + f'<aside><p>{_LONG}</p></aside><article><h1 data-keep>Lamp</h1><p data-keep>{_LONG3}</p><aside class="pullquote"><p>{_LONG2}</p></aside><p data-keep>{_LONG2}</p><form><p>Tell us what you think about this story.</p><button>Send</button></form></article><section class="sponsored ads"><p>{_LONG2}</p></section>' + _FOOT,
)

#: The same pages with their texts exchanged, so that a text's length says little about its label.
_SWAPS = (
    {},
    {_LONG: _SHORT, _LONG2: _LONG3, _LONG3: "Rain.", _SHORT: _LONG2},
    {_LONG: _LONG3, _LONG2: "They left.", _LONG3: _LONG, _SHORT: "Why?"},
    {_LONG: _LONG2, _LONG2: _SHORT, _LONG3: _SHORT, _SHORT: "On the hill, by the wall and under the old trees they waited for the boat"},
    {_LONG: "The boats came back late in fog.", _LONG2: "Two of them were lost, the others damaged.",
     _LONG3: "The mayor spoke and the band played.", _SHORT: "Nobody slept before the morning bell."},
    {_LONG: "The boats came back late in fog.", _LONG2: _LONG2, _LONG3: "Then it snowed over the whole valley.",
     _SHORT: "So they went home"},
)


def _swap(page: str, texts: dict[str, str]) -> str:
    for k, old in enumerate(texts):
        page = page.replace(old, f"\x00{k}\x00")
    for k, new in enumerate(texts.values()):
        page = page.replace(f"\x00{k}\x00", new)
    return page


PAGES = tuple(_swap(p, t) for t in _SWAPS for p in _BASE)
