"""URL filters (operator 7): pattern rules indexed by their rarest literal token.

A rule's regular expression is read for the tokens (runs of letters and digits with borders on both sides) that any URL that it
matches must have. How many URLs hold each such token is counted over the whole table; the rule is filed under its rarest. The index is a
table of (token, rule), hashed by token: a URL's own tokens fetch its candidate rules from it and only those run. Rules with no such token
are candidates for every URL, as constant patterns. All in JVM expressions, without a shuffle of the pages beside the count.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.common import quoted

#: Bytes of an index that is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class Rule:
    """pattern: a regular expression over lower-case URLs that Java and RE2 read alike."""

    name: str
    pattern: str


def _host(words: str) -> str:
    """A pattern of hosts that have one of words between dots and hyphens."""
    return rf"^https?://(?:[^/?#]*[-.@])?\b(?:{words})(?:[-.:/?#]|$)"


def _in_host(words: str) -> str:
    """A pattern of hosts that have one of words anywhere, as in a compound."""
    return rf"^https?://[^/?#]*(?:{words})"


_WARES = "x|xx|xxx|cam|cams|chat|chats|clip|clips|content|date|dating|film|films|fun|movie|movies|only|pics|shop|site|sites|toys|tube|video|videos"

#: Hosts to drop. Words that clean hosts have, too (adult, sex, spam, track), count only beside another word.
UNWANTED = (
    Rule("unwanted_gambling", _host(r"bet|bets|betting|bingo|bookmaker|bookmakers|blackjack|gamble|gambling|lotto|poker|roulette|slots|wager|wagers")),
    Rule("unwanted_gambling_name", _in_host(r"casino|sportsbook|jackpot|onlinepoker|onlineslots|freebets")),
    Rule("unwanted_pills", _host(r"pill|pills|cialis|xanax|valium|(?:cheap|discount|generic|buy)-(?:drugs|meds|medication|pharmacy|rx)")),
    Rule("unwanted_pills_name", _in_host(r"viagra|levitra|tramadol|cheapmeds|cheappills|buypills")),
    Rule("unwanted_adult", _host(rf"(?:adult|adults|sex|sexy)-(?:{_WARES})|(?:live|free|hot|phone)-(?:adult|sex)|erotic|erotica|escorts|milf|nsfw|nudes|camgirl|camgirls")),
    Rule("unwanted_adult_name", _in_host(r"porn|hentai|xxx")),
    Rule("unwanted_ads", _host(r"ads|adserver|adservers|adservice|adclick|adclicks|adtrack|adtracker|adnetwork|doubleclick|clicktrack|clicktracker|popunder|popups|(?:ad|click|pixel|beacon|user|visitor)-(?:click|clicks|network|server|servers|track|tracker|trackers|tracking)")),
    Rule("unwanted_spam", _host(r"linkfarm|linkfarms|spamfarm|spamblog|spammy|splog|(?:spam|link|click)-(?:blog|blogs|farm|farms|links|mill|site|sites|zone)")),
)

RULES = (
    *UNWANTED,
    Rule("tracking_ref", r"[?&]ref="),
    Rule("tracking_utm", r"[?&]utm_(?:source|medium|campaign)="),
    Rule("session_id", r"[?&;](?:sid|sessionid|jsessionid)="),
    Rule("mobile_host", r"^https?://m\."),
    Rule("www_host", r"^https?://www\."),
    Rule("late_page", r"[?&]page=[2-9]"),
    Rule("fragment_top", r"#top$"),
    Rule("print_view", r"/print/|[?&]print=1"),
    Rule("language_path", r"^https?://[^/?#]+/(?:de|es|fr|it|nl|pl|pt|ru)(?:/|$)"),
    Rule("numbered_path", r"^https?://[^/?#]+(?:/[a-z]+)?/[0-9]+(?:[.?#/]|$)"),
    Rule("account_page", r"/(?:login|signup|register|cart|checkout)(?:/|$)"),
    Rule("media_file", r"\.(?:jpg|png|gif|mp4|zip|exe)$"),
    Rule("feed", r"/(?:rss|feed|atom)(?:\.xml|/|$)"),
    Rule("long_number", r"[0-9]{9}"),
    Rule("plain_http", r"^http://"),
    Rule("wiki_talk", r"/wiki/talk:"),
)


def _is_word(c: int) -> bool:
    return chr(c).isascii() and chr(c).isalnum()


def _borders(op: object, arg: object) -> bool:
    """Whether the element matches only characters that end a token, or the URL's own border."""
    if op is sre.AT:
        return arg in (sre.AT_BEGINNING, sre.AT_BEGINNING_STRING, sre.AT_END, sre.AT_END_STRING, sre.AT_BOUNDARY)
    if op is sre.LITERAL:
        return not _is_word(arg)
    if op is sre.IN:
        return all(kind is sre.LITERAL and not _is_word(value) for kind, value in arg)
    if op is sre.SUBPATTERN and len(arg[3]):
        return all(_borders(*x) for x in arg[3])
    if op is sre.BRANCH:
        return all(len(x) and _borders(*x[0]) for x in arg[1])
    return False


def _spread(items: list) -> list[list]:
    """items with groups opened, so that literals beside them join."""
    out = []
    for op, arg in items:
        if op is sre.SUBPATTERN:
            out += _spread(arg[3])
        else:
            out.append((op, arg))
    return out


def required_tokens(pattern: str) -> list[frozenset[str]]:
    """Sets of tokens; a URL that pattern matches has at least one of each set."""
    return _required(_spread(_parser.parse(pattern)))


def _required(items: list) -> list[frozenset[str]]:
    found, word, open_ = [], "", False
    for i, (op, arg) in enumerate(items):
        if op is sre.LITERAL and _is_word(arg):
            word += chr(arg).lower()
            continue
        if word and open_ and _borders(op, arg):
            found.append(frozenset([word]))
        word, open_ = "", _borders(op, arg)
        if op is sre.BRANCH:
            before, after = items[i - 1 : i] if i else [], items[i + 1 : i + 2]
            each = [_required([*before, *_spread(x), *after]) for x in arg[1]]
            if all(each):
                found.append(frozenset().union(*[min(x, key=lambda s: (len(s), sorted(s))) for x in each]))
    return found


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def rarest_tokens(urls: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> dict[str, frozenset[str]]:
    """Each rule's set of required tokens that the fewest URLs of the whole table have; an empty one if the rule has none."""
    wanted = {r.name: required_tokens(r.pattern) for r in rules}
    names = sorted({t for sets in wanted.values() for s in sets for t in s})
    counts: dict[str, int] = {}
    if names:
        tokens = urls.select(F.explode(F.array_intersect(_tokens(quoted(url)), F.array(*map(F.lit, names)))).alias("t"))
        counts = {t: n for t, n in tokens.groupBy("t").count().collect()}  # one row for each token of the rules at most
    return {name: min(sets, key=lambda s: (sum(counts.get(t, 0) for t in s), sorted(s)), default=frozenset()) for name, sets in wanted.items()}


def _index(spark: SparkSession, rules: tuple[Rule, ...], filed: dict[str, frozenset[str]]) -> DataFrame:
    """(token, rule, pattern, among): each rule under each token of its set, all of which are in among."""
    rows = [(token, r.name, r.pattern, sorted(filed[r.name])) for r in rules for token in sorted(filed[r.name])]
    index = spark.createDataFrame(rows, "token string, rule string, pattern string, among array<string>")
    size = sum(len(t) + len(n) + len(p) + sum(map(len, a)) + 100 for t, n, p, a in rows)
    return F.broadcast(index) if size <= BROADCAST_BYTES else index


def _matched(urls: DataFrame, rules: tuple[Rule, ...], filed: dict[str, frozenset[str]]) -> DataFrame:
    """urls' rows, with a column url that isn't null, once for each rule that matches, with the rule."""
    low = F.lower("url")
    open_ = [r for r in rules if not filed[r.name]]
    out = urls.withColumn("rule", F.explode(F.array_compact(F.array(*[F.when(low.rlike(r.pattern), r.name) for r in open_])) if open_ else F.array().cast("array<string>")))
    if len(open_) < len(rules):
        each = urls.withColumn("_tokens", _tokens(F.col("url"))).withColumn("token", F.explode("_tokens"))
        met = each.join(_index(urls.sparkSession, rules, filed), "token")
        # a rule that a URL meets by several tokens of its set runs once
        once = F.col("token") == F.array_min(F.array_intersect("_tokens", "among"))
        out = out.unionByName(met.where(once).where(F.rlike(low, F.col("pattern"))).select(*urls.columns, "rule"))
    return out


def url_matches(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """A row (page_id, url, rule) for each rule that matches a page's URL.

    A null or empty URL has only what rules without tokens match in it (null: nothing). Repeated rows: a result for each. Null page_id:
    stays null. Very long URLs: matched whole. Empty table or no rules: empty result. Other columns: unread. Names must be unique.
    """
    rules = tuple(rules)
    base = pages.select(quoted(page_id).alias("page_id"), quoted(url).alias("url"))
    return _matched(base.where(F.col("url").isNotNull()), rules, rarest_tokens(base, rules))


def drop_matching(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url") -> DataFrame:
    """The rows of pages whose URL no rule matches; rows of null URL stay. All columns are kept. Each distinct URL is judged once."""
    rules = tuple(rules)
    urls = pages.select(quoted(url).alias("url")).where(F.col("url").isNotNull()).distinct()
    hit = _matched(urls, rules, rarest_tokens(urls, rules)).select(F.col("url").alias("_lx_matched")).distinct()
    return pages.join(hit, quoted(url) == hit["_lx_matched"], "left_anti")


def drop_unwanted(pages: DataFrame, rules: tuple[Rule, ...] = UNWANTED, url: str = "url") -> DataFrame:
    """The rows of pages whose host is none to drop; what only plain http, www, a mobile host or a query tells stays. As drop_matching else."""
    return drop_matching(pages, rules, url)
