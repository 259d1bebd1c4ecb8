"""License scan by ordered signature rules, in DataFrame functions only.

Each rule is a hand-written pattern with a label, a kind and a keyword that
all its matches hold.  A text is searched by a rule only when it holds the
rule's keyword (runs of white space count as one space there), so most texts
cost one look for a dozen words.  Overlapping detections are resolved
by order: a detection is suppressed when it lies within one of a kind that
ranks at least as high (``KINDS``, best first), the longer one winning among
equals.

The scan is one pass over the texts, written without them; only detections
are shuffled, by row, for the sweep over their intervals.

Defined results: null text counts as empty; a text without words has
``n_words`` 0 and no labels; every row is scanned by itself, repeated ids
included; positions are in code points; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import c, materialize, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: kinds of rules, best first, with the confidence of a detection
KINDS = {"tag": 1.0, "text": 0.95, "notice": 0.9, "link": 0.8, "name": 0.6}
#: confidence of a base phrase alone
BASE_SCORE = 0.5
#: base phrases: words that stand consecutively, and their label
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache",
           ("general", "public", "license"): "gpl"}

_V = r",?\s*(?:version|v\.?)?\s*"
_OR = r"(?:\s*(?:,|\()?\s*(?:or|and)\s+(?:\(at your option\)\s+)?(?:any\s+)?later(?:\s+versions?)?\)?)?"

#: label, keyword, identifier, name, address: each row gives a tag, a notice
#: and a name rule, and a link rule where there is an address
FAMILIES: list[tuple[str, str, str, str, str]] = [
    ("mit", "mit", r"mit", r"(?:the\s+)?mit(?:/x11|/expat)?[\s-]+licen[cs]e", r"opensource\.org/licenses/mit"),
    ("mit-0", "no attribution", r"mit-0", r"mit\s+no\s+attribution(?:\s+licen[cs]e)?", r"opensource\.org/licenses/mit-0"),
    ("expat", "expat", r"expat", r"expat\s+licen[cs]e", ""),
    ("x11", "x11", r"x11", r"x11\s+licen[cs]e", ""),
    ("isc", "isc", r"isc", r"isc\s+licen[cs]e", r"opensource\.org/licenses/isc"),
    ("apache-1.0", "apache", r"apache-1\.0", r"apache\s+(?:software\s+)?licen[cs]e" + _V + r"1\.0", ""),
    ("apache-1.1", "apache", r"apache-1\.1", r"apache\s+(?:software\s+)?licen[cs]e" + _V + r"1\.1", ""),
    ("apache-2.0", "apache", r"apache-2\.0", r"apache\s+(?:software\s+)?licen[cs]e" + _V + r"2(?:\.0)?", r"apache\.org/licenses/license-2\.0"),
    ("bsd-1-clause", "bsd", r"bsd-1-clause", r"(?:1|one)[\s-]clause\s+bsd(?:\s+licen[cs]e)?", ""),
    ("bsd-2-clause", "bsd", r"bsd-2-clause", r"(?:(?:2|two)[\s-]clause|simplified|freebsd)\s+bsd(?:\s+licen[cs]e)?", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"bsd-3-clause", r"(?:(?:3|three)[\s-]clause|new|revised|modified)\s+bsd(?:\s+licen[cs]e)?", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"bsd-4-clause", r"(?:(?:4|four)[\s-]clause|original|old)\s+bsd(?:\s+licen[cs]e)?", ""),
    ("0bsd", "bsd", r"0bsd", r"(?:0bsd|zero[\s-]clause\s+bsd)(?:\s+licen[cs]e)?", r"opensource\.org/licenses/0bsd"),
    ("bsd", "bsd", r"bsd", r"bsd(?:[\s-]style)?\s+licen[cs]e", ""),
    ("gpl-1.0", "general public", r"gpl-1\.0(?:-only|-or-later|\+)?", r"gnu\s+general\s+public\s+licen[cs]e" + _V + r"1(?:\.0)?" + _OR, r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", "general public", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\s+general\s+public\s+licen[cs]e" + _V + r"2(?:\.0)?" + _OR, r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", "general public", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\s+general\s+public\s+licen[cs]e" + _V + r"3(?:\.0)?" + _OR, r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl", "general public", r"gpl", r"gnu\s+general\s+public\s+licen[cs]e", r"gnu\.org/licenses/gpl(?:\.|/)"),
    ("gpl-2.0-short", "gpl", r"gplv2\+?", r"(?:gnu\s+)?gpl[\s-]*v?2(?:\.0)?\b\+?", ""),
    ("gpl-3.0-short", "gpl", r"gplv3\+?", r"(?:gnu\s+)?gpl[\s-]*v?3(?:\.0)?\b\+?", ""),
    ("lgpl-2.0", "library general", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"gnu\s+library\s+general\s+public\s+licen[cs]e(?:" + _V + r"2(?:\.0)?)?", ""),
    ("lgpl-2.1", "lesser general", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"gnu\s+lesser\s+general\s+public\s+licen[cs]e" + _V + r"2\.1" + _OR, r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", "lesser general", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\s+lesser\s+general\s+public\s+licen[cs]e" + _V + r"3(?:\.0)?" + _OR, r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl", "lesser general", r"lgpl", r"gnu\s+lesser\s+general\s+public\s+licen[cs]e", ""),
    ("agpl-3.0", "affero", r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu\s+affero\s+general\s+public\s+licen[cs]e(?:" + _V + r"3(?:\.0)?)?" + _OR, r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.3", "free documentation", r"gfdl-1\.3(?:-only|-or-later)?", r"gnu\s+free\s+documentation\s+licen[cs]e(?:" + _V + r"1\.3)?", r"gnu\.org/licenses/fdl"),
    ("mpl-1.1", "mozilla", r"mpl-1\.1", r"mozilla\s+public\s+licen[cs]e" + _V + r"1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", "mozilla", r"mpl-2\.0", r"mozilla\s+public\s+licen[cs]e" + _V + r"2(?:\.0)?", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl", "mozilla", r"mpl", r"mozilla\s+public\s+licen[cs]e", ""),
    ("epl-1.0", "eclipse", r"epl-1\.0", r"eclipse\s+public\s+licen[cs]e(?:\s*-)?" + _V + r"1(?:\.0)?", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse", r"epl-2\.0", r"eclipse\s+public\s+licen[cs]e(?:\s*-)?" + _V + r"2(?:\.0)?", r"eclipse\.org/legal/epl-2\.0"),
    ("edl-1.0", "eclipse", r"bsd-3-clause-edl", r"eclipse\s+distribution\s+licen[cs]e", r"eclipse\.org/org/documents/edl-v10"),
    ("cddl-1.0", "common development", r"cddl-1\.0", r"common\s+development\s+and\s+distribution\s+licen[cs]e", r"opensource\.org/licenses/cddl"),
    ("cpl-1.0", "common public", r"cpl-1\.0", r"common\s+public\s+licen[cs]e", r"opensource\.org/licenses/cpl"),
    ("ms-pl", "microsoft public", r"ms-pl", r"microsoft\s+public\s+licen[cs]e", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", "microsoft reciprocal", r"ms-rl", r"microsoft\s+reciprocal\s+licen[cs]e", r"opensource\.org/licenses/ms-rl"),
    ("artistic-1.0", "artistic", r"artistic-1\.0(?:-perl|-cl8)?", r"artistic\s+licen[cs]e" + _V + r"1(?:\.0)?", ""),
    ("artistic-2.0", "artistic", r"artistic-2\.0", r"artistic\s+licen[cs]e" + _V + r"2(?:\.0)?", r"opensource\.org/licenses/artistic-2\.0"),
    ("zlib", "zlib", r"zlib", r"zlib(?:/libpng)?\s+licen[cs]e", r"opensource\.org/licenses/zlib"),
    ("libpng", "libpng", r"libpng(?:-2\.0)?", r"libpng\s+licen[cs]e", ""),
    ("bsl-1.0", "boost", r"bsl-1\.0", r"boost\s+software\s+licen[cs]e(?:" + _V + r"1(?:\.0)?)?", r"boost\.org/license_1_0"),
    ("busl-1.1", "business source", r"busl-1\.1", r"business\s+source\s+licen[cs]e(?:" + _V + r"1\.1)?", r"mariadb\.com/bsl11"),
    ("unlicense", "unlicense", r"unlicense", r"(?:the\s+)?unlicense\b", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl\b", r"wtfpl\.net"),
    ("wtfpl", "do what the f", "", r"do\s+what\s+the\s+f[a-z*]+\s+you\s+want\s+to\s+public\s+licen[cs]e", ""),
    ("cc0-1.0", "cc0", r"cc0-1\.0", r"cc0(?:\s+1\.0)?(?:\s+universal)?", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("odc-by-1.0", "open data commons", r"odc-by-1\.0", r"open\s+data\s+commons\s+attribution\s+licen[cs]e", r"opendatacommons\.org/licenses/by"),
    ("odbl-1.0", "open database", r"odbl-1\.0", r"open\s+database\s+licen[cs]e", r"opendatacommons\.org/licenses/odbl"),
    ("pddl-1.0", "public domain dedication", r"pddl-1\.0", r"open\s+data\s+commons\s+public\s+domain\s+dedication", r"opendatacommons\.org/licenses/pddl"),
    ("ofl-1.1", "open font", r"ofl-1\.1", r"(?:sil\s+)?open\s+font\s+licen[cs]e(?:" + _V + r"1\.1)?", r"scripts\.sil\.org/ofl"),
    ("psf-2.0", "python software", r"psf-2\.0|python-2\.0", r"python\s+software\s+foundation\s+licen[cs]e", ""),
    ("ruby", "ruby", r"ruby", r"ruby(?:'s)?\s+licen[cs]e", ""),
    ("php-3.01", "php", r"php-3\.0?1?", r"php\s+licen[cs]e", r"php\.net/license"),
    ("openssl", "openssl", r"openssl", r"openssl(?:/ssleay)?\s+licen[cs]e", ""),
    ("curl", "curl", r"curl", r"curl\s+licen[cs]e", ""),
    ("w3c", "w3c", r"w3c(?:-\d+)?", r"w3c\s+(?:software\s+)?(?:notice\s+and\s+)?licen[cs]e", r"w3\.org/consortium/legal"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql\s+licen[cs]e", r"opensource\.org/licenses/postgresql"),
    ("ncsa", "ncsa", r"ncsa", r"(?:university\s+of\s+illinois/)?ncsa\s+(?:open\s+source\s+)?licen[cs]e", r"opensource\.org/licenses/ncsa"),
    ("eupl-1.2", "european union public", r"eupl-1\.2", r"european\s+union\s+public\s+licen[cs]e", r"joinup\.ec\.europa\.eu"),
    ("osl-3.0", "open software", r"osl-3\.0", r"open\s+software\s+licen[cs]e", r"opensource\.org/licenses/osl-3\.0"),
    ("afl-3.0", "academic free", r"afl-3\.0", r"academic\s+free\s+licen[cs]e", r"opensource\.org/licenses/afl-3\.0"),
    ("upl-1.0", "universal permissive", r"upl-1\.0", r"universal\s+permissive\s+licen[cs]e", r"opensource\.org/licenses/upl"),
    ("sspl-1.0", "server side public", r"sspl-1\.0", r"server\s+side\s+public\s+licen[cs]e", r"mongodb\.com/licensing/server-side-public-license"),
    ("elastic-2.0", "elastic", r"elastic-2\.0", r"elastic\s+licen[cs]e" + _V + r"2(?:\.0)?", r"elastic\.co/licensing/elastic-license"),
    ("blueoak-1.0.0", "blue oak", r"blueoak-1\.0\.0", r"blue\s+oak\s+model\s+licen[cs]e", r"blueoakcouncil\.org/license"),
    ("cecill-2.1", "cecill", r"cecill-2\.1", r"cecill(?:-[bc])?(?:\s+free\s+software)?\s+licen[cs]e", r"cecill\.info/licences"),
    ("openrail", "openrail", r"openrail", r"(?:creativeml\s+)?openrail(?:\+\+)?(?:-m)?(?:\s+licen[cs]e)?", ""),
    ("openrail", "open rail", "", r"(?:creativeml\s+)?open\s+rail(?:\+\+)?(?:-m)?(?:\s+licen[cs]e)?", ""),
    ("etalab-2.0", "etalab", r"etalab-2\.0", r"etalab\s+open\s+licen[cs]e", r"etalab\.gouv\.fr"),
    ("etalab-2.0", "licence ouverte", "", r"licence\s+ouverte", ""),
]

#: the attribution licenses share one form: parts in the name and in the address
CC = {"by": r"attribution", "by-sa": r"attribution[\s-]+share[\s-]?alike",
      "by-nd": r"attribution[\s-]+no[\s-]?deriv(?:ative|ativework)?s",
      "by-nc": r"attribution[\s-]+non[\s-]?commercial",
      "by-nc-sa": r"attribution[\s-]+non[\s-]?commercial[\s-]+share[\s-]?alike",
      "by-nc-nd": r"attribution[\s-]+non[\s-]?commercial[\s-]+no[\s-]?deriv(?:ative|ativework)?s"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

#: label, keyword, characteristic sentence
TEXTS: list[tuple[str, str, str]] = [
    ("mit", "permission is hereby", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("mit", "without restriction", r"without\s+restriction,\s+including\s+without\s+limitation\s+the\s+rights\s+to\s+use,\s+copy,\s+modify"),
    ("isc", "permission to use", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose"),
    ("bsd", "redistribution and use", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms"),
    ("bsd-3-clause", "neither the name", r"neither\s+the\s+names?\s+of\s+.{1,80}\s+nor\s+the\s+names?\s+of\s+(?:its|their)\s+contributors"),
    ("bsd-4-clause", "all advertising materials", r"all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software"),
    ("apache-2.0", "you may not use this file", r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+license"),
    ("apache-2.0", "as is", r"distributed\s+on\s+an\s+\"as\s+is\"\s+basis,\s+without\s+warranties\s+or\s+conditions"),
    ("gpl", "free software", r"this\s+(?:program|library|file)\s+is\s+free\s+software[;:,]\s+you\s+can\s+redistribute\s+it"),
    ("gpl", "hope that it will be useful", r"distributed\s+in\s+the\s+hope\s+that\s+it\s+will\s+be\s+useful,\s+but\s+without\s+any\s+warranty"),
    ("gpl", "you should have received", r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+general\s+public\s+license"),
    ("lgpl", "you should have received", r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+(?:lesser|library)\s+general\s+public\s+license"),
    ("agpl-3.0", "you should have received", r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+affero\s+general\s+public\s+license"),
    ("mpl-2.0", "source code form", r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+license"),
    ("zlib", "altered source versions", r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked\s+as\s+such"),
    ("unlicense", "public domain", r"free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed|is)\s+(?:in|into|to)\s+the\s+public\s+domain"),
    ("cc0-1.0", "waived all copyright", r"has\s+waived\s+all\s+copyright\s+and\s+related\s+or\s+neighboring\s+rights"),
    ("bsl-1.0", "machine-executable object", r"machine-executable\s+object\s+code\s+generated\s+by\s+a\s+source\s+language\s+processor"),
    ("ofl-1.1", "reserved font name", r"with\s+reserved\s+font\s+names?"),
    ("all-rights-reserved", "all rights reserved", r"all\s+rights\s+reserved"),
    ("proprietary", "proprietary and confidential", r"proprietary\s+and\s+confidential"),
    ("proprietary", "unauthorized copying", r"unauthorized\s+copying\s+of\s+this\s+file"),
    ("proprietary", "unauthorised copying", r"unauthorised\s+copying\s+of\s+this\s+file"),
]

_UNDER = (r"(?:licen[cs]ed|released|distributed|published|provided|(?:made\s+)?available|covered)\s+(?:under|by)\s+"
          r"(?:the\s+)?(?:terms(?:\s+and\s+conditions)?\s+of\s+)?(?:the\s+)?(?:a\s+)?")


def _always_says_license(name: str) -> bool:
    rest = re.sub(r"\(\?:[^()]*licen\[cs\]e[^()]*\)\?", "", name)
    return "licen[cs]e" in rest


def rules() -> list[tuple[str, str, str, str, str]]:
    """Every rule as (label, kind, keyword, second keyword or "", pattern);
    patterns and keywords are for lower-cased text.  Every match of a pattern
    holds both keywords once its white space is folded to single spaces."""
    out = [(label, "text", kw, "", pattern) for label, kw, pattern in TEXTS]
    named = list(FAMILIES)
    for part, words in CC.items():
        for v in CC_VERSIONS:
            dot = v.replace(".", r"\.")
            more = rf"[\s-]*{dot}(?:\s+(?:international|unported|generic))?(?:\s+licen[cs]e)?"
            label, tail = f"cc-{part}-{v}", part.removeprefix("by")
            named += [(label, "cc by", rf"cc-{part}-{dot}", rf"cc\s+by{tail}{more}", rf"creativecommons\.org/licenses/{part}/{dot}"),
                      (label, "cc-by", "", rf"cc-by{tail}{more}", ""),
                      (label, "creative commons", "", rf"creative\s+commons\s+{words}{more}", "")]
    for label, kw, ident, name, link in named:
        second = "licen" if _always_says_license(name) else ""
        if ident:
            out.append((label, "tag", "spdx-license-identifier", "", rf"spdx-license-identifier:\s*(?:{ident})(?![\w.-])"))
        out.append((label, "notice", kw, second, rf"{_UNDER}(?:{name})(?!\w)"))
        out.append((label, "name", kw, second, rf"(?<!\w)(?:{name})(?!\w)"))
        if link:
            out.append((label, "link", re.split(r"[/(]", link)[0].replace("\\", ""), "", link))
    return out


def _literal(table: list[tuple[str, str, str, str, str]]) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("rule"), F.lit(k).alias("keyword"), F.lit(k2).alias("second"), F.lit(p).alias("pattern"))
                     for i, (_, _, k, k2, p) in enumerate(table)))


#: white space that folding changes
_NOT_ONE_SPACE = r"[\t-\r]\s*| \s+"
_A_Z, _a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _phrase_starts(words: Column, phrase: tuple[str, ...]) -> Column:
    def here(i: Column) -> Column:
        ok = F.lit(True)
        for k, w in enumerate(phrase):
            ok = ok & (F.get(words, i + k) == w)
        return ok
    first = F.transform(words, lambda w, i: F.when(w == phrase[0], i))
    return F.filter(F.filter(first, lambda i: i.isNotNull()), here)


def detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               table: list[tuple[str, str, str, str, str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """Scan every text.

    Returns the scanned rows ``(doc_id, uid, n_words, places)``, ``places``
    being the word positions of each base phrase, and the surviving
    detections ``(uid, rule, label, kind, start, end, matched)``.
    """
    table = table or rules()
    text = text_of(text_col)
    words = sorted({k2 or k for _, _, k, k2, _ in table} | {"license"})
    # a keyword that contains another one adds nothing to the gate
    hit = F.lit(False)
    for w in words:
        if not any(o != w and o in w for o in words):
            hit = hit | F.col("flat").contains(w)
    rows = (docs.select(c(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("uid"),
                        text.alias("text"))
            .withColumn("n_words", F.size(F.regexp_extract_all("text", F.lit(WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")), F.lit(0))).cast("long"))
            .withColumn("flat", F.regexp_replace(F.lower("text"), _NOT_ONE_SPACE, " "))
            .withColumn("flat", F.when(hit, F.col("flat")))
            .withColumn("low", F.when(F.col("flat").isNotNull(), F.translate("text", _A_Z, _a_z))))
    rows = rows.withColumn("words", F.when(F.col("low").contains("license"),
                                           F.regexp_extract_all("low", F.lit(WORD), F.lit(0))))
    rows = rows.withColumn("places", F.when(F.col("words").isNotNull(),
                                            F.array(*(_phrase_starts(F.col("words"), p) for p in PHRASES))))

    def found(r: Column) -> Column:
        # the texts between matches give the matches' places
        hits = F.regexp_extract_all(F.col("low"), r["pattern"], F.lit(0))
        gaps = F.split(F.col("low"), r["pattern"], -1)
        at = F.zip_with(hits, gaps, lambda h, g: F.when(h.isNotNull(), F.struct(
            F.length(h).alias("size"), F.length(g).alias("gap"), h.alias("matched"))))
        return F.struct(r["rule"].alias("rule"), F.when(F.regexp_like(F.col("low"), r["pattern"]),
                                                        F.filter(at, lambda x: x.isNotNull())).alias("at"))
    keyed = F.filter(_literal(table), lambda r: F.col("flat").contains(r["keyword"]) & F.col("flat").contains(r["second"]))
    rows = rows.withColumn("hits", F.filter(F.transform(keyed, found), lambda h: h["at"].isNotNull()))
    scanned = materialize(rows.select("doc_id", "uid", "n_words", "places", "hits"), "license_scan")

    each = (scanned.where(F.size("hits") > 0).select("uid", F.explode("hits").alias("h"))
            .select("uid", "h.rule", F.posexplode("h.at").alias("pos", "a")).repartition("uid"))
    along = Window.partitionBy("uid", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    each = each.select("uid", "rule", "a.size", "a.matched",
                       F.sum(F.col("a.gap") + F.col("a.size")).over(along).cast("int").alias("end"))
    ranks = list(KINDS)
    rank = F.element_at(F.array(*(F.lit(ranks.index(k)) for _, k, _, _, _ in table)), F.col("rule") + 1)
    each = each.withColumn("start", F.col("end") - F.col("size")).withColumn("rank", rank)
    # the furthest end so far of each rank or better, in order of start
    sweep = (Window.partitionBy("uid").orderBy("start", F.desc("end"), "rank", "rule")
             .rowsBetween(Window.unboundedPreceding, -1))
    reach = [F.max(F.when(F.col("rank") <= k, F.col("end"))).over(sweep) for k in range(len(ranks))]
    covered = F.coalesce(F.element_at(F.array(*reach), F.col("rank") + 1), F.lit(-1)) >= F.col("end")
    label = F.element_at(F.array(*(F.lit(x) for x, _, _, _, _ in table)), F.col("rule") + 1)
    kind = F.element_at(F.array(*(F.lit(k) for k in ranks)), F.col("rank") + 1)
    kept = (each.withColumn("covered", covered).where(~F.col("covered"))
            .select("uid", "rule", label.alias("label"), kind.alias("kind"), "start", "end", "matched"))
    return scanned, kept


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score)``; the score is the best detection's confidence."""
    scanned, kept = detections(docs, id_col, text_col)
    trust = F.element_at(F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv)), F.col("kind"))
    per = kept.groupBy("uid").agg(F.collect_set("label").alias("found"), F.max(trust).alias("best"))
    none = F.array().cast("array<string>")
    places = F.coalesce(F.flatten("places"), F.array().cast("array<int>"))
    base = F.filter(F.array(*(F.when(F.size(F.get("places", F.lit(i))) > 0, F.lit(x))
                              for i, x in enumerate(PHRASES.values()))), lambda x: x.isNotNull())
    out = scanned.join(per, "uid", "left")
    return (out.withColumn("at", places).withColumn("base", base).select(
        "doc_id", "n_words", F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("best", F.when(F.size("base") > 0, BASE_SCORE), F.lit(0.0)).alias("score")))
