"""Fields of scraped pages and of fixed-width protocol lists."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.rows import keep_first


def field(html: Column, name: str) -> Column:
    """Text of the first element of class field--name-NAME, without tags."""
    return T.strip_tags(F.regexp_extract(html, rf'(?s)class="[^"]*field--name-{re.escape(name)}[^"]*"[^>]*>(.*?)</div>', 1))


def json_ld_name(html: Column) -> Column:
    body = F.regexp_extract(html, r'(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1)
    return T.once(body, lambda b: F.coalesce(F.get_json_object(b, "$.@graph[0].name"), F.get_json_object(b, "$.name"), F.lit("")))


def links(html: Column, kind: str) -> Column:
    """array of struct url, label: links to files of a kind; of one url the last label counts."""
    raw = F.regexp_extract_all(html, F.lit(rf'(?s)<a [^>]*href="([^"]+\.{kind}[^"]*)"[^>]*>.*?</a>'), F.lit(0))
    pair = lambda x: F.struct(F.regexp_extract(x, 'href="([^"]+)"', 1).alias("url"), T.strip_tags(F.regexp_extract(x, "(?s)>(.*)</a>", 1)).alias("label"))
    last = lambda every: F.filter(every, lambda x, i: ~F.exists(F.slice(every, i + 2, F.size(every)), lambda y: y["url"] == x["url"]))
    return T.once(F.transform(raw, pair), last)


def pick_file(files: Column, marks: tuple[str, ...]) -> Column:
    """The first file whose url or label has one of the marks, the marks in order, else the first."""
    hit = lambda every, m: F.get(F.filter(every, lambda x: F.lower(F.concat(x["url"], F.lit(" "), x["label"])).contains(m)), F.lit(0))
    return T.once(files, lambda every: F.coalesce(*[hit(every, m) for m in marks], F.get(every, F.lit(0))))


def speaker_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with country, name, title, date, pdfs, the English pdf and audios."""
    h = F.col(html)
    out = pages.withColumns({"country": field(h, "country"), "title": field(h, "title"), "date": F.left(F.regexp_extract(h, r'datetime="([^"]+)"', 1), F.lit(10)), "pdfs": links(h, "pdf"), "audios": links(h, "mp3")})
    out = out.withColumn("name", F.coalesce(F.nullif(json_ld_name(h), F.lit("")), field(h, "speaker")))
    return out.withColumn("english_pdf", pick_file(F.col("pdfs"), ("_en", "english")))


def archive_slugs(pages: DataFrame, key: str, session: str, html: str = "html") -> DataFrame:
    """key, position and slug of links into a session (empty: into the site's root), without queries and deeper paths, each once in order."""
    below = rf'[^"]*/{re.escape(session)}/' if session else "/"
    found = F.posexplode(F.regexp_extract_all(html, F.lit(rf'href="{below}([^"?#/]+)(?:[?#][^"]*)?"'), F.lit(1))).alias("position", "slug")
    return keep_first(pages.select(key, found), [key, "slug"], [F.col("position")])


def schedule(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, part (morning, afternoon), position and slug of a day's programme; a slug counts where it is seen first."""
    parts = F.filter(F.regexp_extract_all(html, F.lit(r'(?si)<(?:section|div)[^>]*class="[^"]*(?:morning|afternoon)[^"]*".*?</(?:section|div)>'), F.lit(0)), lambda x: x != "")
    blocks = pages.select(key, F.posexplode(parts).alias("_b", "_html"))
    rows = blocks.select(key, "_b", F.lower(F.regexp_extract("_html", "(?i)(morning|afternoon)", 1)).alias("part"), F.posexplode(F.regexp_extract_all("_html", F.lit('href="[^"]*/([^"/?#]+)"'), F.lit(1))).alias("_p", "slug"))
    return keep_first(rows, [key, "slug"], [F.col("_b"), F.col("_p")]).select(key, "part", (F.col("_b") * 10_000 + F.col("_p")).alias("position"), "slug")


def is_waf_page(status: Column, body: Column) -> Column:
    """An answer that is a challenge instead of the page."""
    low = F.lower(F.left(body, F.lit(4000)))
    return ((status == 202) & (F.length(body) < 2000)) | low.contains("awswaf") | low.contains("challenge-platform") | low.contains("captcha")


#: The levels of the three person columns.
COLUMNS = ("HS", "HG", "MFA")
_SAME = re.compile(r"(?i)^same as (?:the )?(.+)$")


def split_columns(line: str, anchors: list[int]) -> list[str]:
    """Pieces of a line (two spaces or more apart), each given to the nearest anchor."""
    out = [""] * len(anchors)
    for m in re.finditer(r"\S+(?: \S+)*", line):
        k = min(range(len(anchors)), key=lambda i: abs(anchors[i] - m.start()))
        out[k] = f"{out[k]} {m[0]}".strip()
    return out


def parse_protocol(text: str) -> list[tuple[str, str, int, str]]:
    """(country, level, position, person) of a fixed-width list: a line in capitals names a country, a header line sets three columns."""
    rows, country, anchors, people = [], "", [], ["", "", ""]

    def close():
        for i, who in enumerate(people):
            same = _SAME.match(who)
            if same:
                at = next((j for j, word in enumerate(("state", "government", "foreign")) if word in same[1].lower()), None)
                who = people[at] if at is not None and not _SAME.match(people[at]) else ""
            if country and who:
                rows.append((country, COLUMNS[i], len(rows), who))

    for line in (text or "").splitlines():
        bare = line.strip()
        if not bare:
            continue
        header = [m.start() for m in re.finditer(r"Head of State|Head of Government|Minister for Foreign Affairs", line)]
        if len(header) == 3:
            anchors = header
        elif bare.isupper() and len(bare.split("  ")) == 1:
            close()
            country, people = bare.title(), ["", "", ""]
        elif anchors and country:
            people = [f"{a} {b}".strip() for a, b in zip(people, split_columns(line, anchors))]
    close()
    return rows


def protocol_people(documents: DataFrame, key: str, text: str) -> DataFrame:
    """key, country, level, position and person of each protocol document."""
    kind = dict(documents.dtypes)[key]

    def run(batches):
        for pdf in batches:
            rows = [(k, *r) for k, t in zip(pdf[key], pdf[text]) for r in parse_protocol(t)]
            yield pd.DataFrame(rows, columns=[key, "country", "level", "position", "person"])

    return documents.select(key, text).mapInPandas(run, f"`{key}` {kind}, country string, level string, position long, person string")
