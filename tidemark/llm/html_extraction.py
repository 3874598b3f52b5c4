"""Main text of pages: a host's suffix array says what its pages repeat, markup says more.

Pages are cut into blocks. Each host's token streams (all blocks of a page, articles too) are
concatenated, page after page, and their suffixes sorted by doubling prefix lengths; suffixes that share
their first ``LONG`` tokens are long substrings, and those found on a sufficient ``SHARE`` of the host's
pages are its boilerplate: the runs they cover are removed wherever they are, unique runs stay. Markup
adds to this: navigation, headers, footers, asides, forms, scripts and the like go as a whole, and where
an article or main element is, what lies outside goes too.

A host's pages are sorted in chunks of about ``CHUNK_TOKENS`` tokens, but of ``CHUNK_CONTENTS`` contents at
least on average, since in a chunk of few pages every substring is frequent. A host of one chunk has its counts by that. A
substring frequent in a host of several chunks is as frequent in at least one of them; those are counted
again over all pages of the host, one row per substring and content. The substrings that stay are looked up
by every page: in a sorted array that each task holds if they are at most ``HELD_NAMES``, and else by a
filter of fixed size and a join. No list of a host's pages is ever gathered.

Inside an article a block goes only if all of it is covered; a run inside a block, which may be a
quotation, only if it is on ``SHARE_INSIDE`` of the host's contents.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, sized, stored, take
from tidemark.llm.decontamination import FILTER_BITS, probes, seed_filter

LONG = 8
CHUNK_TOKENS = 200_000
# Boilerplate is on this share of a host's contents; on two of them at least, and on three to be taken out of
# articles: two that share a passage may be versions of one text.
SHARE, LEAST, LEAST_IN_ARTICLES = 0.05, 2, 3
SHARE_INSIDE = 0.5
# What a repeated substring may cut: open blocks, whole blocks of articles too, runs inside these too.
OPEN_BLOCKS, ARTICLE_BLOCKS, INSIDE = 1, 2, 3
CHUNK_CONTENTS = 60
HELD_NAMES = 1 << 22
HELD_WORDS = 200_000
MIX = np.random.default_rng(5).integers(1, 2**63, LONG, dtype=np.uint64) | np.uint64(1)
# Elements and names by their role.
RAW = frozenset(("script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object"))
CHROME = frozenset(("head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "label", "fieldset"))
MAIN = frozenset(("article", "main"))
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd mark meter "
                    "output picture q ruby rp rt s samp small source span strike strong sub sup time tt u var wbr link meta").split())  # fmt: skip
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME_NAMES = frozenset((
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header legal menu modal nav navbar navigation newsletter notice notification popup promo promoted related "
    "replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget").split())  # fmt: skip
# Names that also count with more after a hyphen or underscore; other compound names are left to the suffix array.
CHROME_PREFIX = re.compile(r"(?:ads?|advert|advertisement|breadcrumbs?|comments?|cookies?|disqus|footer|navbar|newsletter|popup|promo|"
                           r"related|share|sharing|sponsor|sponsored|subscribe)[-_]|(?:reader|user|post|visitor)[-_]comments?$")  # fmt: skip
CHROME_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"))
MAIN_ROLES = frozenset(("main", "article"))
# Fixed values of HTML: elements whose start ends an open paragraph; start tags that end open elements, and where the search for these stops.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr li dt dd main menu nav ol p pre search section summary table ul".split())  # fmt: skip
LISTS, CELLS = frozenset("ul ol menu dl table td th article main".split()), frozenset("table td th caption button".split())
TABLE, SELECT = frozenset(("table",)), frozenset(("select",))
ENDS = {"li": (("li",), LISTS), "dt": (("dt", "dd"), LISTS), "dd": (("dt", "dd"), LISTS), "option": (("option",), SELECT), "optgroup": (("option", "optgroup"), SELECT),
        "td": (("td", "th"), TABLE), "th": (("td", "th"), TABLE), "tr": (("td", "th", "tr"), TABLE), "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot"), TABLE),
        "tfoot": (("td", "th", "tr", "tbody", "thead"), TABLE)}
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>")
# Any attribute, its value consumed with it.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
BLANK = re.compile(r"\s+")
# NAMED: boilerplate by its class or id only, outside articles; an article or main element in it is none.
OPEN, TEXT, BOILER, NAMED = 0, 1, 2, 3


def _role(tag: str, attributes: str, inside: int) -> int | None:
    """What an element makes of its content; None if it does not change it."""
    if tag in CHROME or tag == "header" and inside != TEXT:
        return BOILER
    main = tag in MAIN
    if attributes:
        named = False
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return BOILER
            if name in ("class", "id"):
                named = named or tag not in ("body", "html") and any(v in CHROME_NAMES or CHROME_PREFIX.match(v) for v in value.split())
            elif name == "role":
                if value in CHROME_ROLES:
                    return BOILER
                main = main or value in MAIN_ROLES
            elif name == "itemprop":
                main = main or value == "articlebody"
        if named and inside == TEXT:
            return BOILER
        if named and not main:
            return NAMED
    return TEXT if main else None


def blocks(page: str) -> list[tuple[int, str]]:
    """(role, text) of the page's blocks in order; comments, markup and raw elements are gone.

    Paragraphs, list items, table cells and options end where HTML says that the next one ends them; other
    unclosed elements end with their parent, an unclosed comment or raw element with the page. Broken
    tags end at the next ``>``. Character references are decoded; white space runs become one space.
    """
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = [("", OPEN)]

    def end_block() -> None:
        text = BLANK.sub(" ", entities.unescape("".join(pieces))).strip()
        if text:
            out.append((stack[-1][1], text))
        pieces.clear()

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            pieces.append(page[at:])
            break
        pieces.append(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        m = TAG.match(page, mark)
        if m is None:
            if not re.match(r"</?[A-Za-z]", page[mark : mark + 3]):
                pieces.append("<")
                at = mark + 1
                continue
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            pieces.append(" ")
            continue
        at, closing, tag = m.end(), bool(m[1]), m[2].lower()
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
                at = size if end is None else max(page.find(">", end.start()), end.start()) + 1
            if tag not in ("svg", "math"):
                end_block()
            continue
        role = None if closing else _role(tag, m[3], stack[-1][1])
        if tag in INLINE and role is None:
            if closing and any(name == tag for name, _ in stack):
                end_block()
                _close(stack, tag)
            elif tag == "br":
                pieces.append(" ")
            elif not closing and any(name == tag for name, _ in stack):
                stack.append((tag, stack[-1][1]))
            continue
        end_block()
        if closing:
            _close(stack, tag)
        else:
            if tag in ENDS_P:
                _end(stack, ("p",), CELLS)
            if tag in ENDS:
                _end(stack, *ENDS[tag])
        if not closing and tag not in VOID:
            inside = stack[-1][1]
            # Names do not override an article; an article overrides names around it.
            stack.append((tag, BOILER if inside == BOILER else inside if role is None or inside == NAMED and role == NAMED else role))
    end_block()
    return out


def _end(stack: list[tuple[str, int]], names: Sequence[str], stop: frozenset[str]) -> None:
    """Ends the outermost open element of these names that is inside the innermost of ``stop``."""
    last = len(stack)
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] in stop:
            break
        if stack[i][0] in names:
            last = i
    del stack[last:]


def _close(stack: list[tuple[str, int]], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i][0] == tag:
            del stack[i:]
            return


class _Ids(dict):
    """64-bit ids of words, remembered for a bounded number of them."""

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1)
        return found

    def of(self, texts: Sequence[str]) -> np.ndarray:
        """The ids of a page's blocks as one stream."""
        if len(self) > HELD_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, "\n".join(texts).split()), dtype=np.uint64)


def packed(texts: Sequence[str]) -> bytes:
    """Blocks, which hold no line ends, compressed: they are written and shuffled in this form."""
    data = "\n".join(texts).encode("utf-8", "surrogatepass")
    return len(data).to_bytes(8) + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> list[str]:
    text = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8]), codec="zstd", asbytes=True)
    return text.decode("utf-8", "surrogatepass").split("\n") if text else []


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: its blocks, how many tokens they have, and the hash of its content: of what markup leaves of it."""
    for batch in batches:
        roles, texts, sizes, contents = [], [], [], []
        for page in batch["html"]:
            found = blocks(page.as_py() or "")
            roles.append([role for role, _ in found])
            texts.append(packed([t for _, t in found]))
            sizes.append(sum(len(t.split()) for _, t in found))
            kept = "\n".join(t for role, t in found if role == _wanted(roles[-1]))
            contents.append(int(np.uint64(xxhash.xxh64_intdigest(kept.encode("utf-8", "surrogatepass"), 2)).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], batch["host"], pa.array(roles, pa.list_(pa.int32())), pa.array(texts, pa.binary()),
             pa.array(sizes, pa.int64()), pa.array(contents, pa.int64())],
            ["page_id", "url", "host", "roles", "texts", "size", "content"],
        )


def _wanted(roles: Sequence[int]) -> int:
    """The role of the blocks that markup leaves: those of articles, or the open ones of a page without any."""
    return TEXT if TEXT in roles else OPEN


def suffix_classes(tokens: np.ndarray, page: np.ndarray, long: int = LONG) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array over concatenated streams, to depth ``long``: (sorted starts, class of each).

    Suffixes are ranked by their first 1, 2, 4, ... tokens; equal rank means an equal prefix. A suffix
    that leaves its page before ``long`` tokens is a class of its own.
    """
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64)
    # Places beyond a page's end never equal another place.
    lone = n + np.arange(n + long, dtype=np.int64)
    depth = 1
    while depth < long:
        step = min(depth, long - depth)
        ahead = np.where(np.arange(n) + step < n, np.append(rank[step:], lone[:step])[:n], lone[:n])
        other = np.append(page[step:], np.full(step, -1))[:n] != page
        ahead = np.where(other, lone[:n], ahead)
        order = np.argsort(rank * (lone[-1] + 1) + ahead)
        fresh = np.append(True, (rank[order][1:] != rank[order][:-1]) | (ahead[order][1:] != ahead[order][:-1]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(fresh) - 1
        lone = n + np.arange(n + long, dtype=np.int64) + rank.max(initial=0)
        depth += step
    order = np.argsort(rank, kind="stable")
    return order, rank[order]


def window_names(tokens: np.ndarray, host: str) -> np.ndarray:
    """A name for the ``LONG`` tokens from each start on, another one on each host."""
    n = max(0, len(tokens) - LONG + 1)
    name = np.full(n, xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"), 3), dtype=np.uint64)
    for k in range(LONG):
        name += tokens[k : k + n] * MIX[k]
    name ^= name >> np.uint64(29)
    name *= MIX[0]
    return name ^ (name >> np.uint64(32))


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops most further pages of one content before they are shuffled."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        fresh = []
        for page in zip(batch["host"].to_pylist(), batch["content"].to_pylist(), strict=True):
            fresh.append(page not in seen)
            seen.add(page)
        if len(seen) > HELD_WORDS:
            seen.clear()
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long substrings frequent in their chunk: on how many contents of it, and of how many of the host; rows are sorted by chunk."""
    ids, key, streams, seen = _Ids(), None, [], set()

    def chunk() -> pa.RecordBatch:
        host, _, parts, contents = key
        tokens = np.concatenate(streams)
        page = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
        order, rank = suffix_classes(tokens, page)
        whole = np.append(page[LONG - 1 :], np.full(LONG - 1, -1))[: len(page)] == page
        order, rank = order[whole[order]], rank[whole[order]]
        first = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(rank) else np.empty(0, dtype=np.int64)
        # Suffixes of one class are in the order of their places, so those of one page are neighbours.
        at = page[order]
        fresh = np.append(True, (rank[1:] != rank[:-1]) | (at[1:] != at[:-1]))[: len(rank)].astype(np.int64)
        n = np.add.reduceat(fresh, first) if len(first) else fresh
        found = n >= (max(LEAST, SHARE * contents) if parts == 1 else SHARE * len(streams))
        names = window_names(tokens, host)[order[first[found]]]
        return pa.RecordBatch.from_pydict({
            "name": names.view(np.int64), "n": n[found], "contents": np.full(len(names), contents), "whole": np.full(len(names), parts == 1)
        })

    for batch in batches:
        for *new, content, texts in zip(*[batch[c].to_pylist() for c in ("host", "part", "parts", "contents", "content")], batch["texts"], strict=True):
            if streams and new != key:
                yield chunk()
                streams.clear(), seen.clear()
            key = new
            if content not in seen:
                seen.add(content)
                streams.append(ids.of(unpacked(texts.as_py())))
    if streams:
        yield chunk()


def _occurrences(bitmap_of) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, ids = bitmap_of.value, _Ids()
        for batch in batches:
            found = []
            for host, data in zip(batch["host"].to_pylist(), batch["texts"], strict=True):
                names = window_names(ids.of(unpacked(data.as_py())), host)
                one, two = probes(names, FILTER_BITS)
                at = np.flatnonzero((bitmap[one >> 3] >> (one & 7).astype(np.uint8)) & (bitmap[two >> 3] >> (two & 7).astype(np.uint8)) & 1)
                found.append((at, names[at].view(np.int64)))
            if not found:
                continue
            n = [len(at) for at, _ in found]
            yield pa.RecordBatch.from_pydict({
                "row": np.repeat(batch["row"].to_numpy(), n), "content": np.repeat(batch["content"].to_numpy(), n),
                "at": np.concatenate([at for at, _ in found]).astype(np.int32), "name": np.concatenate([names for _, names in found]),
            })

    return run


def _passing(parsed: DataFrame, names: DataFrame) -> DataFrame:
    """(row, content, at, name) where pages hold one of the names, and of a few others that the filter takes for one."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = probes(batch["name"].to_numpy().view(np.uint64), FILTER_BITS)
            yield pa.RecordBatch.from_pydict({"one": one, "two": two})

    bitmap = parsed.sparkSession.sparkContext.broadcast(seed_filter(names.select("name").mapInArrow(marks, "one long, two long")))
    return parsed.select("row", "host", "content", "texts").mapInArrow(_occurrences(bitmap), "row long, content long, at int, name long")


def unrepeated(texts: Sequence[str], kept: Sequence[bool], starts: Sequence[int], inside: Sequence[int] | None = None) -> list[str]:
    """The kept blocks without the runs of tokens covered by the substrings at ``starts``.

    Only substrings at ``inside`` (all, if None) cut a run out of a block, the others take whole blocks; so
    does a substring that crosses blocks: the words it shares with the next block by chance stay with that block.
    """
    words = [t.split() for t in texts]
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    within, covered = np.zeros(len(of), dtype=bool), np.zeros(len(of), dtype=bool)
    for i in starts:
        covered[i : i + LONG] = True
    for i in starts if inside is None else inside:
        if of[i] == of[i + LONG - 1]:
            within[i : i + LONG] = True
    out, end = [], 0
    for t, w, wanted in zip(texts, words, kept, strict=True):
        begin, end = end, end + len(w)
        if wanted and not covered[begin:end].all():
            gone = within[begin:end]
            out.append(" ".join(x for x, g in zip(w, gone, strict=True) if not g) if gone.any() else t)
    return out


def _unrepeated(roles: Sequence[int], texts: Sequence[str], at: np.ndarray, cuts: np.ndarray) -> str:
    """A page's text; substrings that may cut ``cuts`` are at ``at``."""
    wanted = _wanted(roles)
    kept = [r == wanted for r in roles]
    starts, inside = (at[cuts >= ARTICLE_BLOCKS], at[cuts >= INSIDE]) if wanted == TEXT else (at, None)
    return "\n".join(unrepeated(texts, kept, starts, inside) if len(starts) else [t for t, k in zip(texts, kept, strict=True) if k])


def _keep(held_of) -> object:
    """Pages looked up in the sorted names, which every task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (held, cuts), ids = held_of.value, _Ids()
        for batch in batches:
            out = []
            for host, roles, data in zip(batch["host"].to_pylist(), batch["roles"].to_pylist(), batch["texts"], strict=True):
                texts = unpacked(data.as_py())
                names = window_names(ids.of(texts), host) if len(held) else held
                place = np.minimum(np.searchsorted(held, names), len(held) - 1)
                at = np.flatnonzero(held[place] == names) if len(held) else place
                out.append(_unrepeated(roles, texts, at, cuts[place[at]]))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string())], ["page_id", "url", "text"])

    return run


def _keep_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for roles, texts, at, cuts in zip(*[batch[c].to_pylist() for c in ("roles", "texts", "at", "cuts")], strict=True):
            out.append(_unrepeated(roles, unpacked(texts), np.array(at or [], dtype=np.int64), np.array(cuts or [], dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, columns: Sequence[str] = ("page_id", "url", "html")) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    A NULL or empty page, and one without text, has the empty text. Pages with an article or main element
    give that element's blocks, other pages their blocks that are no boilerplate by markup; of either the
    runs covered by substrings of ``LONG`` or more tokens are removed that are found on at least ``SHARE``
    of the host's contents, ``LEAST`` of them. In articles it takes ``LEAST_IN_ARTICLES`` contents, and inside a
    block that is not covered whole ``SHARE_INSIDE`` of the host's. Pages with the same
    text by markup are one content. A NULL URL or one without ``://`` belongs to the empty host. Repeated
    pages each get their row; an empty table gives none. Further columns are ignored.
    """
    host = ascii_lower(F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))
    picked = take(pages, *columns).toDF("page_id", "url", "html").withColumn("page_id", F.col("page_id").cast("long"))
    parsed = picked.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        _parse, "page_id long, url string, host string, roles array<int>, texts binary, size long, content long"
    )
    parsed = stored(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")

    # One page of each content is sorted; hosts of one content repeat nothing.
    each = parsed.groupBy("host", "content").agg(F.max("size").alias("size"))
    hosts = each.groupBy("host").agg(F.count(F.lit(1)).alias("contents"), F.sum("size").alias("size")).filter(F.col("contents") > 1)
    parts = F.least(F.ceil(F.col("size") / CHUNK_TOKENS), F.floor(F.col("contents") / CHUNK_CONTENTS))
    hosts = stored(hosts.select("host", "contents", F.greatest(F.lit(1), parts).alias("parts")), "page-hosts")
    once = parsed.select("host", "content", "texts").mapInArrow(_once, "host string, content long, texts binary").join(sized(hosts), "host")
    dealt = once.withColumn("part", F.pmod(F.xxhash64("content"), F.col("parts"))).select("host", "part", "parts", "contents", "content", "texts")
    dealt = dealt.repartition("host", "part").sortWithinPartitions("host", "part")
    frequent = stored(dealt.mapInArrow(_frequent, "name long, n long, contents long, whole boolean"), "page-substrings")

    # Names of hosts of several chunks are counted over all their pages; one row per name on either side of the join.
    chunked = stored(frequent.filter(~F.col("whole")).groupBy("name").agg(F.first("contents").alias("contents")), "page-candidates")
    several = parsed.join(sized(hosts.filter(F.col("parts") > 1).select("host")), "host", "left_semi")
    on = _passing(several, chunked).select("name", "content").distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    counted = frequent.filter("whole").select("name", "n", "contents").unionByName(chunked.join(on, "name").select("name", "n", "contents"))
    n, contents = F.col("n"), F.col("contents")
    cuts = F.when((n >= LEAST_IN_ARTICLES) & (n >= SHARE_INSIDE * contents), INSIDE).when(n >= LEAST_IN_ARTICLES, ARTICLE_BLOCKS).otherwise(OPEN_BLOCKS)
    repeated = stored(counted.filter((n >= LEAST) & (n >= SHARE * contents)).select("name", cuts.alias("cuts")), "page-repeated")

    result = "page_id long, url string, text string"
    if repeated.limit(HELD_NAMES + 1).count() <= HELD_NAMES:
        held = repeated.toArrow()
        names = held["name"].to_numpy().view(np.uint64)
        order = np.argsort(names)
        shared = pages.sparkSession.sparkContext.broadcast((names[order], held["cuts"].to_numpy().astype(np.int8)[order]))
        judged = parsed.select("page_id", "url", "host", "roles", "texts").mapInArrow(_keep(shared), result)
    else:
        places = _passing(parsed, repeated).join(repeated, "name")
        starts = stored(places.groupBy("row").agg(F.collect_list(F.struct("at", "cuts")).alias("found")), "page-starts")
        starts = starts.select("row", F.col("found.at").alias("at"), F.col("found.cuts").alias("cuts"))
        judged = parsed.select("row", "page_id", "url", "roles", "texts").join(starts, "row", "left").mapInArrow(_keep_joined, result)
    return judged.withColumn("n_chars", F.length("text").cast("long"))
