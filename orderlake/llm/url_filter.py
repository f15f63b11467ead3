"""URL filter: host and path rules, then a weighted vocabulary.

A rule ``host/path`` fits its host and all subdomains when the url's path starts
with the rule's path; the longest fitting rule decides.  Where no rule fits, an
Aho-Corasick automaton counts vocabulary terms in the lower-cased url.  A term
counts when no letter or digit touches it on either side.  A url is blocked on
one strict term or on several distinct soft terms, each with its weight.

NULL urls and urls without ``://`` have an empty host and path; the terms are
still looked for in what there is.  Repeated rows are judged each by itself.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlake.llm.corpus import per_text

# fixed values: the rules of the registered query
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

#: One of these is enough.
STRICT = tuple("""
    porn porno pornos pornstar pornstars pornography freeporn gayporn xxx xxxvideos casino onlinecasino livecasino
    viagra cialis levitra escort escorts hentai camgirl camgirls camsex sexcam sexcams livesex sexchat sextube
    sexvideo sexvideos sexshop cybersex blowjob gangbang bukkake creampie cumshot deepthroat handjob milf bdsm
    fetishism upskirt stripclub swingers malware phishing ransomware spyware keylogger botnet warez keygen keygens
    crackz serialz
""".split())
#: Distinct ones add up, with the weight before them.
SOFT = {term: weight for weight, terms in ((1.0, """
    ads adult bet betting dating gambling loan pills poker popup sex slots spam track tracker x sexy erotic erotica
    nude nudes naked nsfw fetish lingerie webcam webcams hookup hookups milfs stripper strippers swinger bingo
    roulette blackjack baccarat jackpot lottery lotto sportsbook bookmaker wager wagers betslip payday loans lender
    forex crypto pharmacy pharma steroids tramadol xanax valium weightloss diet crack cracked cracks torrent
    torrents pirated nulled hack hacks hacked exploit trojan virus adware popunder clickbait doorway scam replica
    replicas counterfeit
"""), (0.5, """
    cheap click free hot promo win discount coupon coupons deal deals bonus prize prizes winner earn cash money rich
    singles girls teens babes amateur cams live chat vip gratis offer offers affiliate redirect banner banners
    sponsor download downloads serial codes unlimited guaranteed instant
""")) for term in terms.split()}
SOFT_LIMIT = 2.0

#: Escapes of ASCII characters that can be printed, in lower case.
ESCAPED = re.compile("%([2-7][0-9a-f])")

COLUMNS = "host string, path string, rule string, verdict string, strict_hits int, soft_weight double"
TYPES = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.float64())


class Verdict(NamedTuple):
    host: str
    path: str
    rule: str | None
    verdict: str
    strict_hits: int
    soft_weight: float


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def plain(url: str) -> str:
    """The text that terms are looked for in: ASCII escapes resolved once, A-Z lower-cased."""
    low = ascii_lower(url)
    return ascii_lower(ESCAPED.sub(lambda found: chr(int(found[1], 16)), low)) if "%" in low else low


def touches(character: str) -> bool:
    return unicodedata.category(character)[0] in "LMN"


def split_url(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for i in (path.find(c) for c in "?#") if i >= 0), default=len(path))
    return ascii_lower(rest[:end]), path[:stop]


class UrlJudge:
    """Rules by host suffix and the automaton over all terms; built once per task."""

    def __init__(self, rules: Iterable[tuple[str, str]] = RULES, strict: Iterable[str] = STRICT,
                 soft: dict[str, float] | None = None, limit: float = SOFT_LIMIT):
        self.limit = limit
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, path = rule.split("/", 1)
            self.by_host.setdefault(host, []).append((f"/{path}", rule, verdict))
        self.terms = ahocorasick.Automaton()
        for term in strict:
            self.terms.add_word(term, (term, None))
        for term, weight in (SOFT if soft is None else soft).items():
            if not self.terms.exists(term):
                self.terms.add_word(term, (term, weight))
        if len(self.terms):
            self.terms.make_automaton()

    def rule_for(self, host: str, path: str) -> tuple[str, str] | None:
        best = None
        suffix = host
        while suffix:
            for prefix, rule, verdict in self.by_host.get(suffix, ()):
                if path.startswith(prefix) and (best is None or len(rule) > len(best[0])):
                    best = (rule, verdict)
            suffix = suffix.partition(".")[2]
        return best

    def term_hits(self, url: str | None) -> tuple[int, float]:
        """Strict hits, and the summed weight of the distinct soft terms."""
        if not url or not len(self.terms):
            return 0, 0.0
        text = plain(url)
        strict, soft = 0, {}
        for end, (term, weight) in self.terms.iter(text):
            before, after = end - len(term), end + 1
            if before >= 0 and touches(text[before]) or after < len(text) and touches(text[after]):
                continue
            if weight is None:
                strict += 1
            else:
                soft[term] = weight
        return strict, float(sum(soft[t] for t in sorted(soft)))

    def judge(self, url: str | None) -> Verdict:
        host, path = split_url(url)
        strict, soft = self.term_hits(url)
        found = self.rule_for(host, path)
        if found:
            return Verdict(host, path, found[0], found[1], strict, soft)
        return Verdict(host, path, None, "block" if strict or soft >= self.limit else "allow", strict, soft)


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", **vocabulary) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, strict hits and soft weight.

    Only the key and url columns are read.
    """
    def make():
        judge = UrlJudge(**vocabulary)

        def work(urls: list) -> list[pa.Array]:
            found = list(zip(*map(judge.judge, urls)))
            return [pa.array(c, t) for c, t in zip(found, TYPES)]

        return work

    return per_text(pages.select(key, url), url, make, COLUMNS)
