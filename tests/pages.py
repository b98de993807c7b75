"""Listing sites made up for these tests, one behaviour after another, and their rules and registry.

* ``dome``: nested sections, dates without an offset read in the rule's zone, several slots and
  images, a price next to a house number.
* ``rowing``: a JSON-LD array at the top, and a rule that yields one image where a list belongs.
* ``market``: a second page by rule, an exact and a one-day-apart duplicate on it, and a third page
  that only the second one names.
* ``lights``: month links, dates in attributes of ``data`` elements.
* ``climb``: JSON-LD in a graph, sessions in definition lists.
* ``shut``: switched off, without a rule file.
"""

from __future__ import annotations

import json

REGISTRY = """source_id,base_url, type ,country,robots_ok,sitemap_url,css_rules_path,crawl_freq,max_qps,concurrency,enabled
dome,https://dome.example.net/programm,events,DE,true,,dome.yaml,weekly,3,2,true
rowing,https://rowing.example.net/season,sports,NZ,true,,rowing.yaml,daily,1,1,true
market,https://market.example.net/stalls/,events,JP,true,,market.yaml,daily,2,4,yes
lights,https://lights.example.net/may,festivals,PT,true,https://lights.example.net/all.xml,lights.yaml,weekly,1,1,1
climb,https://climb.example.net/,sports,ZA,true,,climb.yaml,daily,,,TRUE
shut,https://shut.example.net/,events,IE,true,,missing.yaml,weekly,1,1,false
"""

RULES = {
    "dome.yaml": """
selectors: {list_item: "main section.talk"}
fields:
  title: "h2"
  start: "p.runs@data-begin"
  end: "p.runs@data-finish"
  time_slots: "ol.sittings b"
  venue: "address em"
  addr: "address i"
  city: "address u"
  country: "address abbr"
  price_text: "var.fee"
  organizer: "cite"
  images: "figure img@src[]"
date_scopes: {timezone: "Europe/Berlin"}
pagination: {max_pages: 1}
""",
    "rowing.yaml": """
selectors: {list_item: "#heats article"}
fields:
  title: "header"
  sport_type: "header@data-kind"
  time_slots: "footer"
  venue: "q"
  addr: "q@title"
  city: "q@lang"
  country: "q@cite"
  images: "picture img::attr(data-large)"
date_scopes: {timezone: "Pacific/Auckland"}
""",
    "market.yaml": """
selectors: {list_item: "div[role='listitem']"}
fields:
  title: "strong"
  start: "data.opens@value"
  end: "data.closes@value"
  venue_name: "span.hall"
  address: "span.gate"
  city: "span.ward"
  country: "span.land"
  detail_url: "strong > a@href"
pagination: {next_selector: "nav > a.forward@href", max_pages: 4}
""",
    "lights.yaml": """
selectors: {list_item: "figure.glow"}
fields:
  title: "figcaption"
  start: "data[class='lit']@value"
  end: "data[class='dark']@value"
  venue_name: "small.quay"
  address: "small.pier"
  city: "small.port"
  country: "small.flag"
  images: "img@data-src[]"
pagination: {month_grid: true, max_pages: 2}
""",
    "climb.yaml": """
selectors: {list_item: "dl"}
fields:
  title: "dt"
  sport_type: "dd.style"
  start: "dd.when@data-day"
  time_slots: "dd.when"
  venue_name: "dd.wall"
  address: "dd.road"
  city: "dd.town"
  country: "dd.land"
pagination: {max_pages: 1}
""",
}


def ld(node) -> str:
    return f'<script type="application/ld+json">{json.dumps(node)}</script>'


def entry(kind, name, start, end, place, **more):
    """A JSON-LD node; place is (name, street, city, country)."""
    where = dict(zip(("streetAddress", "addressLocality", "addressCountry"), place[1:], strict=True))
    return {
        "@type": kind, "name": name, "startDate": start, "endDate": end,
        "location": {"name": place[0], "address": where}, **more,
    }


def talk(title, begin, finish, extra=""):
    return (
        f"<section class='talk'><h2>{title}</h2><p class=runs data-begin='{begin}' "
        f"data-finish='{finish}'></p><address><em>Kuppel</em><i>Am Hang 4</i><u>Jena</u>"
        f"<abbr>DE</abbr></address>{extra}</section>"
    )


def stall(title, day):
    return (
        f"<div role='listitem'><strong><a href='/stall/{day}'>{title}</a></strong>"
        f"<data class=opens value='{day}T09:30:00+09:00'></data>"
        f"<data class=closes value='{day}T16:15:00+09:00'></data><span class=hall>Kura</span>"
        "<span class=gate>3-9 Kawabata</span><span class=ward>Kanazawa</span>"
        "<span class=land>JP</span></div>"
    )


def glow(title, day):
    return (
        f"<figure class='glow'><figcaption>{title}</figcaption>"
        f"<data class='lit' value='{day}T20:00:00+01:00'></data>"
        f"<data class='dark' value='{day}T23:45:00+01:00'></data><small class=quay>Cais</small>"
        "<small class=pier>Doca 11</small><small class=port>Aveiro</small>"
        f"<small class=flag>PT</small><img data-src='https://lights.example.net/{day}.webp'></figure>"
    )


DOME = "https://dome.example.net/programm"
MARKET = "https://market.example.net/stalls/"
MARKET_2 = "https://market.example.net/stalls/more"

PAGES = {
    DOME: ld(
        entry(
            "Event", "Comet Jazz", "2027-02-05T19:15:00+01:00", "2027-02-05T21:00:00+01:00",
            ("Planetarium", "88 Sternweg", "Jena", "DE"), offers={"price": "17.25"},
        )
    )
    + "<main>"
    + talk(
        "Art of the Sundial", "2027-07-09T11:00:00", "2027-07-09T15:30:00+02:00",
        "<ol class=sittings><li><b>2027-07-09T11:00:00+02:00|2027-07-09T12:00:00+02:00</b>"
        "<li><b>2027-07-09T14:30:00+02:00|2027-07-09T15:30:00+02:00</b></ol><var class=fee>gratis</var>"
        "<cite>Sternfreunde</cite><figure><img src='https://dome.example.net/dial.png'>"
        "<img src='https://dome.example.net/noon.png'></figure>",
    )
    + talk("Dark Skies", "2027-11-12T18:00:00", "2027-11-12T20:00:00")
    + talk("Moon Maps", "2027-11-26T18:00:00", "2027-11-26T20:00:00")
    + "</main><nav><a class=forward href=later>later</a></nav>",
    "https://rowing.example.net/season": ld(
        [
            entry(
                "SportsEvent", name, f"2027-01-{day}T08:20:00+13:00", f"2027-01-{day}T09:05:00+13:00",
                ("Boathouse", "2 Wharf Lane", "Whanganui", "NZ"), sport="Rowing",
            )
            for name, day in [("Single Sculls", 16), ("Coxed Four", 23)]
        ]
    )
    + "<div id=heats><article><header data-kind=Rowing>Novice Heat</header>"
    "<q title='2 Wharf Lane' lang=Whanganui cite=NZ>Boathouse</q>"
    "<picture><img data-large='https://rowing.example.net/heat.avif'></picture>"
    "<footer>2027-01-30T08:00:00+13:00|2027-01-30T08:40:00+13:00</footer></article></div>",
    MARKET: ld(
        entry(
            "Event", "Koto Recital", "2027-10-30T14:00:00+09:00", "2027-10-30T15:40:00+09:00",
            ("Kura", "3-9 Kawabata", "Kanazawa", "JP"), eventTimeZone="Asia/Tokyo",
        )
    )
    + stall("Lacquer Fair", "2027-11-06") + stall("Kite Making", "2027-11-13")
    + stall("Kite Making", "2027-11-14") + "<nav><a class=forward href='more'>forward</a></nav>",
    MARKET_2: stall("Tea Tasting", "2027-12-04") + stall("Paper Folding", "2027-12-05")
    + stall("Lacquer Fair", "2027-11-06") + stall("Indigo Dyeing", "2027-12-11")
    + stall("Kite Making", "2027-11-15") + "<nav><a class=forward href='last'>forward</a></nav>",
    "https://market.example.net/stalls/last": stall("Never Visited", "2027-12-30"),
    "https://lights.example.net/may": "<a class='month-next' href='june'>junho</a>"
    + glow("Candle Walk", "2027-05-14"),
    "https://lights.example.net/june": glow("Glow Week", "2027-06-03")
    + glow("Neon Evening", "2027-06-18") + glow("Mirror Maze", "2027-06-29"),
    "https://climb.example.net/": ld(
        {
            "@graph": [
                entry(
                    "SportsEvent", name, f"2027-03-20T{hour}:00:00+02:00", f"2027-03-20T{hour}:50:00+02:00",
                    ("Quarry", "14 Krans Road", "Paarl", "ZA"), sport="Climbing",
                )
                for name, hour in [("Lead Class", "09"), ("Boulder Class", "13")]
            ]
        }
    )
    + "<dl><dt>Dawn Circuit</dt><dd class=style>Running</dd>"
    "<dd class=when data-day='2027-03-21T05:45:00+02:00'>"
    "2027-03-21T05:45:00+02:00|2027-03-21T06:30:00+02:00</dd><dd class=wall>Quarry</dd>"
    "<dd class=road>14 Krans Road</dd><dd class=town>Paarl</dd><dd class=land>ZA</dd></dl>",
}
