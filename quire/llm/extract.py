"""HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: stop-word density,
length and link density decide a block as article or boilerplate; what stands
in a container that names itself (nav, header, footer, aside, form, an advert,
a notice, comments) is boilerplate, and where the page marks its article
(article, main), text outside of it is boilerplate. Text inside is the article's
but for such containers, for lists of links (blocks that are mostly links and
stand next to one another), and for blocks with some links and few stop words. Missing stop words alone take nothing out of a marked
article (lists of ingredients, names and figures have none). In a header inside
an article headings and whole sentences stay. Second pass: blocks left ambiguous,
short ones above all, take the label of the nearest decided neighbours; a heading
that of what follows. If no block of a page was decided to be good, the
ambiguous ones that end like a sentence are.

The stop words are those of the list that fits most of the page's text; where
none fits, length and link density alone decide.

A container names itself by a whole class name or id, or by one made of such
words and of words for any container (search-form, ad-slot-1). It is layout, not boilerplate, if it holds <main>; a
kind that is also put round whole pages (form, sidebar, widget) if it holds the
only marked article or most of the page's text without links; any other if it
holds an article and most of that text. What stands inside a marked article
must hold nearly all of the articles' text to be layout.

Row-local, no shuffle; memory is that of one page. The walk is linear in the page.

Defined results: null or empty html, or a page without article text, gives an
empty text. Broken markup never fails: an unclosed container ends with its
first block, an unclosed comment or script with the page. Repeated rows each
get their result. Other columns pass through.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT = 70
LONG = 200
STOP_LOW = 0.15
STOP_HIGH = 0.30
LINKS = 0.5
#: Link density that needs stop words beside it.
FEW_LINKS = 0.2
#: Words from which a sentence in an article's header is a lead, not a byline.
LEAD_WORDS = 8
#: The least share of a page's text that a list of stop words must fit, and the share from which no other list is tried.
FITS = 0.25
FITS_WELL = 0.9
#: Shares of the text without links, of a page and of its marked articles.
MOST = 0.5
NEARLY = 0.8

# Common function words: of English, French, German and Spanish together, then of other languages.
STOP_WORDS = frozenset("""
a about after all also an and are as at be been but by can could do for from had has have he her his how i if in into is it its
just like more my no not of on one only or other our out she so some than that the their them then there these they this to up us
was we were what when which who will with would you your
au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui ma mais me mes mon ne nos notre nous on ou
où par pas plus pour qu que qui sa sans se ses son sont sur ta te tes toi ton tu un une vos votre vous
aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer es für hat ich ihr im
in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wenn wie wir wird zu zum zur
al ante como con cuando de del desde donde el ella ellos en entre era es esta este esto fue ha hay la las lo los más me mi muy ni
no nos o para pero por porque qué se ser si sin sobre son su sus también te tiene todo un una uno y ya yo
""".split())

MORE_STOP_WORDS = tuple(frozenset(words.split()) for words in (
    """a ad ai al alla alle anche che chi ci come con cui da dal dalla degli dei del della delle di dove e è era essere fra gli ha hanno i il in
    io la le lei li lo loro lui ma mi molto ne nel nella noi non o per perché più quando quella quello questa questo se si sia sono su sua sul
    sulla suo ti tra tu tutti un una uno""",
    """aan al als bij dan dat de der deze die dit door dus een en er geen had heb heeft hem het hij hoe hun ik in is ja je kan maar me meer men met
    mijn na naar niet nog nu of om omdat ons ook op over te tegen toch toen tot u uit van veel voor want was wat we werd wie wij wordt zal ze zich
    zij zijn zo zou""",
    """a ao aos as até com como da das de dela dele do dos e é ela ele eles em entre era essa esse esta está este eu foi há isso já lhe mais mas me
    mesmo meu muito na não nas nem no nos nós o os ou para pela pelo por qual quando que quem se sem ser seu só sua são também te tem um uma você""",
    """а без был была были было быть в вам вас вот все всё вы где да для до его ее её если есть еще ещё же за и из или им их к как когда кто ли мне мы
    на надо не нет него ни но ну о об он она они от по под при с со так такой там то того тоже только том тут ты у уже чем что чтобы эти это этого этот я""",
    """a aby ale bo być był była było by co czy dla do go i ich im ja jak jako je jego jej jest już jeszcze k kiedy która które który lub ma mi może
    na nad nie niż o od on ona oni po pod przez przy są się ta tak także tam te tego tej ten to tu tylko tym u w we wszystko z za ze że""",
    """att av blev bli den denna det de dem där då efter ej eller en er ett från för ha hade han har hon i in inte jag kan kunde man med men mot
    mycket nu när och om oss på sig sin ska skulle som så till under upp ut utan var vi vid är över af at blev der deres du efter eller et for fra
    ham hans hun hvad hvis ikke jeg kunne mig mod når og også være var til vil ved af at av etter hva hvor ikke noe seg""",
    """ale ani až bez by byl byla bylo být co či do ho i já jak jako je jeho její jen ještě jsem jsme jsou k kde kdy když která které který ma má mezi mi
    na nad ne nebo není o od on ona po pod podle pro proto protože před při s se si sú tak také tam ten to toto tím u už v ve však z za ze že""",
    """ama ancak bana bazı ben beni bir biz bu bunu çok çünkü da daha de değil diye en gibi göre hem hep her için ile ise kadar ki kim mı mi mu mü
    nasıl ne neden o olan olarak olduğu oldu onu onun sen siz şey şu tüm var ve veya ya yok""",
    """ja on ei se että oli hän en ovat mutta kun niin joka mitä kuin myös sen tai ole nyt jos ne me hänen sitä siitä sekä vain mukaan kanssa""",
    """a az és hogy nem is egy ez volt meg de csak ha már el mint még van azt vagy ki mert lesz én ezt be te fel minden amely ami között után""",
    """και το η ο να του της με που την από για είναι τα στο οι δεν θα τον σε τη στην τις των ένα μια ως αυτό ή αλλά τους στα κατά""",
    """في من على إلى أن عن مع هذا هذه التي الذي كان كانت لا ما لم قد أو ثم بعد قبل بين كل هو هي ذلك كما و إن حيث عند لن وقد منذ غير""",
    """के का की में है और से को पर यह ने कि हैं ही भी था थे थी एक इस तो जो कर हो या वह नहीं लिए गया अपने""",
    """的 了 在 是 我 有 和 就 不 人 都 一 也 很 到 說 说 要 去 你 會 会 着 著 沒 没 這 这 那 他 她 它 們 们 為 为 與 与 及 或 但 而 於 于 以 之 從 从 對 对 被 把 將 将 還 还 又 等 中 上 下 個 个 來 来 其
    の に は を た が で て と し れ さ い る も な か ら り こ す う ま お""",
))

_RAW = "script|style|noscript|template|svg|math|textarea|select|iframe|object|title|canvas|audio|video"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({_RAW})\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))|<[!?][^>]*>"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-z][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CJK = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff"
_WORD = re.compile(rf"[{_CJK}]|[^\W\d_{_CJK}][^\W\d_{_CJK}\u0900-\u0903\u093c-\u094d]*(?:[\u0900-\u0903\u093c-\u094d]+[^\W\d_{_CJK}]*)*")
_WIDE = re.compile(f"[{_CJK}\uac00-\ud7af]")
_SENTENCE_END = re.compile(r"[.!?…。！？।؟][\"'»”’」』)）]*$")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none")

_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody
td tfoot th thead tr ul""".split())
_CONTAINER = _BLOCK - frozenset("p hr h1 h2 h3 h4 h5 h6 html body pre option dt dd caption summary legend address".split())
_OUT_TAGS = frozenset("nav footer aside form menu dialog head fieldset".split())
_MUTE = frozenset(("button", "label"))  # form controls that may stand inside a line
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_OUT_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments
commentlist consent cookie cookies copyright disclaimer discussion disqus dropdown footer form gdpr header login masthead menu menus modal
nav navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion recommended related
replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toolbar
topbar widget""".split())
# Words in class names that say nothing of what a container holds.
_PLAIN_NAMES = frozenset("area bar block box container group holder inner item items left links list outer panel posts results right row section slot top unit user wrap wrapper zone".split())
# Of these, the ones that are also put round whole pages.
_WRAPS = frozenset("""banner dialog dropdown fieldset footer form header login masthead menu menus modal nav navbar navigation notice notices
notification overlay pager popup search share sharing sidebar skip social tags toolbar topbar widget""".split())
_WRAP_TAGS = frozenset("form fieldset dialog".split())
_WRAP_ROLES = frozenset("search form dialog".split())
_MAIN_NAMES = frozenset(("articlebody", "article-body", "article-content", "entry-content", "post-content", "post-body", "story-body", "main-content"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


def _role_of(tag: str, attributes: str) -> str:
    """"out" for a container of boilerplate ("wrap": of a kind also put round whole pages),
    "main" or "article" for the article's, "header", or ""."""
    if tag in _OUT_TAGS:
        return "wrap" if tag in _WRAP_TAGS else "out"
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    if _HIDDEN.search(attributes):
        return "out"
    role = found.get("role", "").lower()
    if role in _OUT_ROLES:
        return "wrap" if role in _WRAP_ROLES else "out"
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if names and tag != "main" and role != "main":
        outs = [parts for parts in map(_name_parts, names) if parts and parts <= _OUT_NAMES]
        if outs:
            return "wrap" if all(parts <= _WRAPS for parts in outs) else "out"
    if tag == "header":
        return "header"
    if tag == "main" or role == "main":
        return "main"
    if tag == "article" or role == "article" or found.get("itemprop", "").lower() == "articlebody" or {n.lower() for n in names} & _MAIN_NAMES:
        return "article"
    return ""


def _name_parts(name: str) -> set[str]:
    """The words of a class name or id, without numbers and words for any container; the name itself if it
    is a known one. A word with digits inside it is no word that is known."""
    if name.lower() in _OUT_NAMES:
        return {name.lower()}
    if any(re.search(r"[a-z]\d|\d[a-z]", part, re.I) for part in re.split(r"[-_]", name)):
        return set()
    return {p.lower() for p in _PART.findall(name) if not p.isdigit()} - _PLAIN_NAMES


class Block:
    __slots__ = ("text", "links", "out", "main", "heading", "inside", "known", "listed")

    def __init__(self, text: str, links: int, out: bool, main: bool, heading: bool, inside: int = -1):
        self.text, self.links, self.out, self.main, self.heading, self.inside = text, links, out, main, heading, inside
        self.listed = False  # one of a list of links
        self.known: list[str] | None = None

    def words(self) -> list[str]:
        if self.known is None:
            self.known = _WORD.findall(self.text.lower())
        return self.known


class Outs:
    """The containers of boilerplate of a page, outer ones first."""

    def __init__(self):
        self.up: list[int] = []  # the next outer one, or -1
        self.wrap: list[bool] = []
        self.in_article: list[bool] = []
        self.holds: list[set[str]] = []  # kinds of article containers that open inside

    def open(self, up: int, wrap: bool, in_article: bool) -> int:
        self.up.append(up)
        self.wrap.append(wrap)
        self.in_article.append(in_article)
        self.holds.append(set())
        return len(self.up) - 1

    def settle(self, found: list[Block], free_article: bool) -> None:
        """Mark the blocks that stand in a container which is not just layout;
        free_article: an article container opens outside of all of them."""
        size, total, articles = [0] * len(self.up), 0, 0
        for b in found:
            plain = len(b.text) - b.links
            total += plain
            articles += plain * b.main
            if b.inside >= 0:
                size[b.inside] += plain
        for i in range(len(self.up) - 1, -1, -1):
            if self.up[i] >= 0:
                size[self.up[i]] += size[i]
                self.holds[self.up[i]] |= self.holds[i]
        out = []
        for i, up in enumerate(self.up):
            most = size[i] > (NEARLY * articles if self.in_article[i] else MOST * total)
            if "main" in self.holds[i]:
                layout = True
            elif self.wrap[i]:
                layout = most or bool(self.holds[i]) and not free_article and not self.in_article[i]
            else:
                layout = most and bool(self.holds[i])
            out.append(not layout or up >= 0 and out[up])
        for b in found:
            b.out = b.out or b.inside >= 0 and out[b.inside]


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order."""
    found: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked: list[str] = []
    in_link = breaks = main = headers = 0
    outs, inside, free_article = Outs(), -1, False
    heading = mute = ""
    hidden = False
    lower = page.lower()
    last_close: dict[str, int] = {}

    def end_block() -> None:
        nonlocal breaks, hidden, mute
        if parts:
            text = "" if hidden else " ".join(html.unescape("".join(parts)).split())
            if text:
                links = len(" ".join(html.unescape("".join(linked)).split())) if linked else 0
                block = Block(text, links, False, main > 0, bool(heading), inside)
                block.out = headers > 0 and not (main > 0 and (heading or _is_lead(block)))
                found.append(block)
            parts.clear()
            linked.clear()
        breaks, hidden, mute = 0, False, ""

    def count(role: str, by: int) -> None:
        nonlocal inside, free_article, main, headers
        if role in ("out", "wrap"):
            inside = outs.open(inside, role == "wrap", main > 0) if by > 0 else outs.up[inside]
        elif role in ("main", "article"):
            main += by
            if by > 0 and inside >= 0:
                outs.holds[inside].add(role)
            free_article = free_article or inside < 0
        headers += by * (role == "header")

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            if not mute:
                parts.append(piece)
                if in_link:
                    linked.append(piece)
            if breaks and not piece.isspace():
                breaks = 0
        at = m.end()
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                end_block()
        elif tag == "a":
            in_link = 0 if closing else 1
        elif tag in _MUTE:  # ends with its own tag, or with the block
            mute = "" if closing else tag
            parts.append(" ")
        elif tag in _BLOCK or tag in _OUT_TAGS:
            end_block()
            if tag in _HEADINGS:
                heading = "" if closing else tag
            elif tag == "p":
                heading = ""
            if tag not in _CONTAINER and tag not in _OUT_TAGS:
                hidden = not closing and bool(m[4]) and _HIDDEN.search(m[4]) is not None
                continue
            in_link = 0
            if not closing:
                if tag not in last_close:
                    last_close[tag] = lower.rfind(f"</{tag}")
                role = _role_of(tag, m[4])
                if last_close[tag] > at or role in ("main", "article"):  # a container that is never closed holds nothing but its first block
                    if role in ("main", "article") and headers:
                        headers = 0
                    stack.append((tag, role))
                    count(role, 1)
            else:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        for _, role in reversed(stack[k:]):
                            count(role, -1)
                        headers = max(0, headers)
                        del stack[k:]
                        break
    if at < len(page):
        parts.append(page[at:])
    end_block()
    outs.settle(found, free_article)
    return found


GOOD, BAD, OPEN = 1, 0, None


def _is_lead(b: Block) -> bool:
    """A whole sentence, mostly without links."""
    return b.links <= LINKS * len(b.text) and len(b.words()) >= LEAD_WORDS and _SENTENCE_END.search(b.text) is not None


def mark_link_lists(found: list[Block]) -> None:
    """Marks blocks that are mostly links and stand next to another one."""
    mostly = [b.links > LINKS * len(b.text) and not b.heading for b in found]
    for i, b in enumerate(found):
        b.listed = mostly[i] and (i > 0 and mostly[i - 1] or i + 1 < len(found) and mostly[i + 1])


def _size(b: Block) -> int:
    """Length in characters; a character of the scripts without word spaces counts as three."""
    return len(b.text) if b.text.isascii() else len(b.text) + 2 * len(_WIDE.findall(b.text))


def _density(words: list[str], stops: frozenset[str]) -> float:
    return sum(w in stops for w in words) / max(1, len(words))


def stop_list(found: list[Block], marked: bool) -> frozenset[str] | None:
    """The list of stop words that fits most of the text of the page, or of its marked article; None if none fits."""
    texts = [(len(b.text), b.words()) for b in found
             if not b.out and (b.main or not marked) and b.links <= LINKS * len(b.text) and _size(b) >= SHORT]
    total, best, fits = sum(n for n, _ in texts), None, 0
    for stops in (STOP_WORDS, *MORE_STOP_WORDS):
        own = sum(n for n, words in texts if _density(words, stops) >= STOP_LOW)
        if own > fits:
            best, fits = stops, own
        if fits >= FITS_WELL * total:
            break
    return best if fits and fits >= FITS * total else None


def first_pass(b: Block, marked: bool, stops: frozenset[str] | None) -> int | None:
    """Good, bad or open, by the block itself; marked: the page marks its article; stops: the page's stop words."""
    if b.out or marked and (not b.main or b.listed):
        return BAD
    n, size = len(b.text), _size(b)
    if b.links > LINKS * n and not b.heading:
        return GOOD if marked else BAD
    if size < SHORT or b.heading:
        return OPEN
    if marked:  # here few stop words count only beside links
        return BAD if stops is not None and b.links > FEW_LINKS * n and _density(b.words(), stops) < STOP_LOW else GOOD
    if stops is None:
        if b.links > FEW_LINKS * n:
            return BAD
        return GOOD if size >= LONG or _SENTENCE_END.search(b.text) else OPEN
    density = _density(b.words(), stops)
    if density >= STOP_HIGH or density >= STOP_LOW and size >= LONG:
        return GOOD
    return OPEN if density >= STOP_LOW else BAD


def second_pass(found: list[Block], labels: list[int | None], marked: bool) -> list[int]:
    """Open blocks take their nearest decided neighbours' label: that of both if they
    agree, else the nearer one's; a heading goes with what follows. Inside a marked
    article only other blocks of the article are neighbours, and good is the rule."""
    n = len(labels)
    before, after = [-1] * n, [n] * n
    see = lambda i: labels[i] is not None and (not marked or found[i].main and not found[i].out)
    for i in range(1, n):
        before[i] = i - 1 if see(i - 1) else before[i - 1]
    for i in range(n - 2, -1, -1):
        after[i] = i + 1 if see(i + 1) else after[i + 1]
    rule = GOOD if marked else BAD
    out = []
    for i, label in enumerate(labels):
        if label is None:
            a = labels[before[i]] if before[i] >= 0 else rule
            b = labels[after[i]] if after[i] < n else rule
            if a == b or found[i].heading:
                label = b
            elif marked:
                label = GOOD
            else:
                label = a if before[i] >= 0 and i - before[i] <= after[i] - i else b
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    """The article of a page, one line a block."""
    if not page:
        return ""
    found = blocks(page)
    marked = any(b.main and not b.out for b in found)
    stops = stop_list(found, marked)
    mark_link_lists(found)
    labels = [first_pass(b, marked, stops) for b in found]
    if GOOD not in labels:  # a page of short paragraphs
        labels = [GOOD if x is OPEN and not b.heading and _SENTENCE_END.search(b.text) else x for b, x in zip(found, labels)]
    labels = second_pass(found, labels, marked)
    return "\n".join(b.text for b, label in zip(found, labels) if label == GOOD)


@F.arrow_udf(T.StringType())
def _extract(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extracted(page: Column) -> Column:
    """The article text of an html column."""
    return _extract(page.cast("string"))
