"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at every block-level tag. A block is described by its own words and link
density, by those of the blocks before and after it, by its element (heading, running text, other) and by
where it stands (in furniture of the page, in the container that the page gives to its content). Words like
"related" or "discussion" name furniture on one page and an article's section on the next; what stands under
such a name is left to the rest of the features. A decision tree, grown from the small
labelled table below, tells content from the rest; the content blocks in page order are the text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("""article aside blockquote body details dialog div dl fieldset figure footer form header html
li main menu nav ol section span table ul""".split())
SKIPPED = frozenset("""annotation annotation-xml button canvas datalist head iframe noembed noframes noscript object option script select
style svg template textarea title audio video""".split())
FURNITURE_TAGS = frozenset("aside footer menu nav dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RUNNING = frozenset("p li blockquote pre dd dt td th caption figcaption".split())
#: Parts of a class or id that name furniture, wherever they occur.
FURNITURE_PARTS = re.compile(
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|gdpr|popup|modal|overlay|nav|navbar|menu\w*|breadcrumb\w*|"
    r"sidebar\w*|aside|widget\w*|footer|masthead|topbar|toolbar|comments|commentlist|respond|disqus\w*|newsletter|subscribe|"
    r"signup|login|pagination|pager")
#: Parts that name furniture alone or with each other, and may name an article's section together with other words.
TOPIC_PARTS = re.compile(
    r"navigation|consent|notices?|alert|side|foot|header|comment|related|recommend\w*|shar(?:e|ing)|social\w*|subscription|"
    r"search|form|copyright|legal|disclaimer|skip")
#: Parts that name a discussion of readers or of an article.
EITHER_PARTS = re.compile(r"discussion|reply|replies")
#: Parts that say nothing beside one of those.
PLAIN_PARTS = re.compile(
    r"\d\w*|\w|list|box|block|section|area|wrap|wrapper|container|inner|outer|items?|links?|bar|top|bottom|left|right|posts?|articles?|"
    r"stories|news|reading|site|page|global|main|content|body|text|title|author|meta|icons?|buttons?|slot|unit|group|row|col|column|"
    r"panel|primary|secondary|and|the")
CONTENT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:article|articlebody|content|maincontent|main|post|entry|story|text|body)(?=$|[\s_-])", re.I)

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: What a wrapper says about its parts, and the heading part of an article.
_LAYOUT = re.compile(r"(?:^|(?<=\s))\S*(?:has|no|with|without)[-_]\S*", re.I)
_OWN_HEADER = re.compile(r"(?:^|(?<=\s))(?:\w+[-_])?header(?=\s|$)", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
#: Articles that are a comment or an advert.
_OTHERS = re.compile(r"comment(?:[_-]\w+)?|comments|reply|ads?|advert\w*|promo\w*|sponsor\w*|teaser", re.I)
#: How clearly a block stands in furniture. An article inside a form or under an open name stands for itself.
OPEN, FORM, FURNITURE = 1, 2, 3

FEATURES = ("furniture", "open_name", "in_content", "page_has_content", "kind", "words", "link_density", "words_before",
            "density_before", "words_after", "density_after")
#: The labelled table, in the order of FEATURES (kind: 2 heading, 1 running text, 0 other), then 1 for content.
#: Invented blocks: paragraphs, headings, lists and short lines of articles; menus, lists of links, adverts, footers,
#: sidebars, forms and comments around them.
LABELLED = (
    # inside the container of the content
    (0, 0, 1, 1, 1, 55, 0.00, 8, 0.0, 60, 0.0, 1), (0, 0, 1, 1, 2, 8, 0.00, 6, 1.0, 55, 0.0, 1),
    (0, 0, 1, 1, 0, 1, 0.00, 40, 0.0, 30, 0.0, 1), (0, 0, 1, 1, 1, 3, 1.00, 40, 0.0, 30, 0.0, 1),
    (0, 0, 1, 1, 1, 120, 0.10, 3, 0.0, 0, 0.0, 1), (0, 0, 1, 1, 1, 2, 0.00, 2, 1.0, 4, 0.0, 1),
    (0, 0, 1, 1, 1, 12, 0.60, 70, 0.0, 9, 0.0, 1), (0, 0, 1, 1, 1, 400, 0.02, 0, 0.0, 12, 0.0, 1),
    (0, 0, 1, 1, 2, 5, 0.00, 2, 0.0, 1, 1.0, 1), (0, 0, 1, 1, 1, 20, 0.00, 1, 1.0, 7, 0.0, 1),
    (0, 0, 1, 1, 1, 9, 1.00, 30, 0.0, 25, 0.0, 1), (0, 0, 1, 1, 0, 6, 0.00, 0, 0.0, 0, 0.0, 1),
    (0, 0, 1, 1, 1, 35, 0.70, 20, 0.0, 3, 0.0, 1), (0, 0, 1, 1, 2, 4, 1.00, 12, 0.0, 50, 0.0, 1),
    (0, 0, 1, 1, 1, 4, 1.00, 16, 0.0, 15, 0.0, 1), (0, 0, 1, 1, 1, 2, 1.00, 5, 0.0, 7, 0.0, 1),
    (0, 0, 1, 1, 1, 6, 1.00, 22, 0.0, 0, 0.0, 1), (0, 0, 1, 1, 1, 5, 1.00, 9, 0.1, 2, 0.0, 1),
    # text before or after links
    (0, 0, 1, 1, 1, 3, 0.00, 40, 0.0, 3, 1.0, 1), (0, 0, 1, 1, 1, 16, 0.00, 8, 0.0, 4, 1.0, 1),
    (0, 0, 1, 1, 1, 28, 0.05, 1, 0.0, 12, 1.0, 1), (0, 0, 1, 1, 1, 45, 0.10, 60, 0.0, 6, 1.0, 1),
    (0, 0, 1, 1, 0, 12, 0.00, 3, 1.0, 2, 1.0, 1), (0, 0, 1, 1, 2, 2, 0.00, 0, 0.0, 5, 1.0, 1),
    (0, 0, 1, 1, 1, 9, 0.30, 20, 0.0, 30, 0.9, 1), (0, 0, 1, 1, 1, 70, 0.00, 5, 1.0, 2, 1.0, 1),
    (0, 0, 1, 1, 0, 4, 0.00, 30, 0.0, 40, 1.0, 1), (0, 0, 1, 1, 1, 5, 0.00, 2, 0.0, 25, 0.8, 1),
    (0, 0, 1, 1, 1, 30, 0.00, 60, 0.0, 2, 1.0, 1), (0, 0, 1, 1, 1, 4, 0.00, 70, 0.0, 3, 0.0, 1),
    (0, 0, 1, 1, 0, 2, 0.00, 90, 0.0, 1, 0.0, 1), (0, 0, 1, 1, 2, 2, 0.00, 65, 0.0, 3, 1.0, 1),
    (0, 0, 1, 1, 0, 3, 0.00, 66, 0.0, 2, 1.0, 1), (0, 0, 1, 1, 1, 10, 0.00, 120, 0.0, 4, 0.5, 1),
    (0, 0, 1, 1, 1, 6, 0.20, 58, 0.0, 1, 1.0, 1), (0, 0, 1, 1, 0, 5, 0.00, 75, 0.0, 2, 1.0, 1),
    # one link alone
    (0, 0, 1, 1, 0, 3, 1.00, 20, 0.0, 15, 0.0, 1), (0, 0, 1, 1, 0, 5, 1.00, 2, 0.0, 40, 0.0, 1),
    (0, 0, 1, 1, 1, 4, 1.00, 1, 0.0, 9, 0.0, 1), (0, 0, 1, 1, 0, 2, 1.00, 0, 0.0, 3, 0.0, 1),
    (0, 0, 1, 1, 1, 3, 1.00, 2, 0.1, 0, 0.0, 1), (0, 0, 1, 1, 0, 8, 1.00, 70, 0.0, 55, 0.0, 1),
    # links beside links
    (0, 0, 1, 1, 1, 3, 1.00, 12, 0.0, 2, 1.0, 0), (0, 0, 1, 1, 1, 4, 1.00, 1, 1.0, 90, 0.0, 0),
    (0, 0, 1, 1, 0, 2, 1.00, 3, 1.0, 20, 0.0, 0), (0, 0, 1, 1, 1, 3, 1.00, 6, 1.0, 5, 1.0, 0),
    (0, 0, 1, 1, 1, 2, 1.00, 40, 0.0, 1, 1.0, 0), (0, 0, 1, 1, 1, 1, 1.00, 2, 1.0, 1, 1.0, 0),
    (0, 0, 1, 1, 1, 1, 1.00, 1, 1.0, 35, 0.0, 0), (0, 0, 1, 1, 1, 7, 1.00, 9, 1.0, 6, 1.0, 0),
    (0, 0, 1, 1, 0, 3, 1.00, 2, 1.0, 0, 0.0, 0), (0, 0, 1, 1, 0, 12, 0.95, 50, 0.0, 11, 0.9, 0),
    # links beside one link with a remark
    (0, 0, 1, 1, 1, 12, 0.30, 10, 0.4, 14, 0.3, 1), (0, 0, 1, 1, 1, 30, 0.50, 4, 1.0, 25, 0.4, 1),
    # under an open name inside the content
    (0, 1, 1, 1, 2, 1, 0.00, 17, 0.0, 4, 0.0, 1), (0, 1, 1, 1, 2, 2, 0.00, 9, 0.0, 2, 0.0, 1),
    (0, 1, 1, 1, 1, 40, 0.00, 2, 0.0, 50, 0.0, 1), (0, 1, 1, 1, 1, 14, 0.05, 1, 0.0, 0, 0.0, 1),
    (0, 1, 1, 1, 2, 2, 0.00, 60, 0.0, 45, 0.0, 1), (0, 1, 1, 1, 1, 4, 0.00, 1, 0.0, 9, 0.0, 1),
    (0, 1, 1, 1, 0, 25, 0.00, 30, 0.0, 40, 0.0, 1), (0, 1, 1, 1, 2, 1, 0.00, 30, 0.0, 6, 0.0, 1),
    (0, 1, 1, 1, 0, 5, 0.00, 20, 0.0, 15, 0.0, 1), (0, 1, 1, 1, 1, 6, 0.00, 25, 0.0, 0, 0.0, 1),
    (0, 1, 1, 1, 2, 2, 0.00, 60, 0.0, 3, 1.0, 0), (0, 1, 1, 1, 1, 3, 1.00, 2, 0.0, 4, 1.0, 0),
    (0, 1, 1, 1, 1, 8, 1.00, 1, 0.0, 0, 0.0, 0), (0, 1, 1, 1, 0, 4, 0.75, 60, 0.0, 0, 0.0, 0),
    (0, 1, 1, 1, 0, 2, 0.00, 70, 0.0, 2, 1.0, 0), (0, 1, 1, 1, 1, 20, 0.80, 3, 1.0, 18, 0.7, 0),
    # furniture
    (1, 0, 1, 1, 1, 30, 0.00, 60, 0.0, 40, 0.0, 0), (1, 0, 1, 1, 1, 3, 1.00, 60, 0.0, 40, 0.0, 0),
    (1, 0, 1, 1, 1, 80, 0.05, 9, 0.0, 70, 0.0, 0), (1, 0, 1, 1, 0, 6, 0.20, 30, 0.0, 6, 0.2, 0),
    (1, 0, 0, 1, 1, 1, 1.00, 0, 0.0, 1, 1.0, 0), (1, 0, 0, 1, 0, 45, 0.00, 2, 1.0, 9, 0.0, 0),
    (1, 0, 0, 1, 0, 9, 0.10, 50, 0.0, 0, 0.0, 0), (1, 0, 0, 0, 1, 1, 1.00, 0, 0.0, 1, 1.0, 0),
    (1, 0, 0, 0, 1, 70, 0.00, 9, 0.0, 80, 0.0, 0), (1, 0, 0, 0, 0, 10, 0.10, 60, 0.0, 0, 0.0, 0),
    (1, 0, 0, 0, 0, 25, 0.30, 12, 0.5, 40, 0.0, 0), (1, 0, 0, 0, 2, 4, 0.00, 90, 0.0, 3, 0.0, 0),
    (1, 0, 0, 0, 2, 6, 0.00, 0, 0.0, 30, 0.0, 0), (1, 0, 1, 1, 2, 1, 0.00, 50, 0.0, 12, 0.0, 0),
    # outside the container of the content
    (0, 0, 0, 1, 0, 7, 0.00, 1, 1.0, 9, 0.0, 0), (0, 0, 0, 1, 1, 35, 0.00, 4, 0.0, 10, 0.0, 0),
    (0, 0, 0, 1, 1, 3, 0.90, 3, 0.9, 2, 1.0, 0), (0, 0, 0, 1, 0, 14, 0.50, 60, 0.0, 0, 0.0, 0),
    (0, 0, 0, 1, 1, 60, 0.00, 50, 0.0, 6, 0.0, 0), (0, 0, 0, 1, 2, 2, 0.00, 70, 0.0, 8, 0.0, 0),
    (0, 0, 0, 1, 1, 80, 0.00, 5, 0.0, 90, 0.0, 0), (0, 0, 0, 1, 1, 40, 0.00, 60, 0.0, 35, 0.0, 0),
    (0, 0, 0, 1, 2, 9, 0.00, 30, 0.0, 44, 0.0, 0), (0, 1, 0, 1, 1, 30, 0.00, 30, 0.0, 44, 0.0, 0),
    (0, 0, 0, 1, 1, 200, 0.00, 2, 1.0, 30, 0.0, 0), (0, 1, 0, 1, 2, 2, 0.00, 25, 0.0, 21, 0.0, 0),
    # pages that give their content no container: running text and headings
    (0, 0, 0, 0, 1, 60, 0.00, 8, 0.0, 50, 0.0, 1), (0, 0, 0, 0, 1, 25, 0.04, 3, 1.0, 45, 0.0, 1),
    (0, 0, 0, 0, 1, 150, 0.15, 2, 1.0, 2, 1.0, 1), (0, 0, 0, 0, 2, 6, 0.00, 45, 0.0, 52, 0.0, 1),
    (0, 0, 0, 0, 2, 8, 0.00, 2, 1.0, 60, 0.0, 1), (0, 0, 0, 0, 1, 33, 0.20, 25, 0.1, 40, 0.0, 1),
    (0, 0, 0, 0, 1, 5, 0.00, 3, 0.0, 4, 0.0, 1), (0, 0, 0, 0, 1, 4, 0.00, 5, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 2, 2, 0.00, 0, 0.0, 5, 0.0, 1), (0, 0, 0, 0, 2, 3, 0.00, 1, 1.0, 6, 0.0, 1),
    (0, 0, 0, 0, 1, 2, 0.00, 20, 0.0, 18, 0.0, 1), (0, 0, 0, 0, 1, 9, 0.00, 60, 0.0, 25, 0.0, 1),
    (0, 0, 0, 0, 1, 16, 0.00, 20, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 2, 1, 0.00, 16, 0.0, 90, 0.0, 1),
    (0, 1, 0, 0, 1, 40, 0.00, 30, 0.0, 35, 0.0, 1), (0, 1, 0, 0, 2, 2, 0.00, 30, 0.0, 40, 0.0, 1),
    (0, 0, 0, 0, 1, 14, 0.00, 20, 0.0, 3, 1.0, 1), (0, 0, 0, 0, 1, 20, 0.00, 1, 1.0, 3, 1.0, 1),
    (0, 0, 0, 0, 1, 35, 0.10, 12, 0.0, 6, 0.9, 1), (0, 0, 0, 0, 1, 11, 0.00, 30, 0.0, 10, 0.8, 1),
    # the same: other elements
    (0, 0, 0, 0, 0, 40, 0.00, 50, 0.0, 0, 0.0, 1), (0, 0, 0, 0, 0, 70, 0.05, 45, 0.0, 3, 1.0, 1),
    (0, 0, 0, 0, 0, 22, 0.00, 12, 0.0, 6, 0.0, 1), (0, 0, 0, 0, 0, 95, 0.00, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 0, 0, 35, 0.10, 2, 1.0, 4, 0.0, 1), (0, 0, 0, 0, 0, 16, 0.00, 20, 0.0, 14, 0.0, 1),
    (0, 0, 0, 0, 0, 4, 0.00, 30, 0.0, 28, 0.0, 1), (0, 0, 0, 0, 0, 5, 0.20, 33, 0.0, 17, 0.1, 1),
    (0, 0, 0, 0, 0, 18, 0.00, 40, 0.0, 2, 1.0, 1), (0, 0, 0, 0, 0, 8, 0.00, 40, 0.0, 0, 0.0, 0),
    (0, 0, 0, 0, 0, 4, 0.00, 80, 0.0, 2, 0.0, 0), (0, 0, 0, 0, 0, 2, 0.00, 1, 1.0, 5, 0.0, 0),
    (0, 0, 0, 0, 0, 4, 0.00, 16, 0.0, 0, 0.0, 0), (0, 0, 0, 0, 0, 7, 0.00, 14, 0.0, 0, 0.0, 0),
    (0, 0, 0, 0, 0, 3, 0.00, 0, 0.0, 4, 0.0, 0), (0, 0, 0, 0, 0, 5, 0.00, 25, 0.0, 3, 0.0, 0),
    # the same: links and what stands among them
    (0, 0, 0, 0, 1, 1, 1.00, 1, 1.0, 1, 1.0, 0), (0, 0, 0, 0, 1, 3, 1.00, 0, 0.0, 2, 1.0, 0),
    (0, 0, 0, 0, 1, 30, 0.90, 4, 1.0, 5, 1.0, 0), (0, 0, 0, 0, 0, 20, 0.70, 3, 1.0, 60, 0.0, 0),
    (0, 0, 0, 0, 2, 3, 0.00, 2, 1.0, 2, 1.0, 0), (0, 0, 0, 0, 2, 5, 0.00, 40, 0.0, 3, 1.0, 0),
    (0, 0, 0, 0, 0, 2, 1.00, 60, 0.0, 1, 1.0, 0), (0, 0, 0, 0, 1, 45, 0.60, 50, 0.0, 6, 0.0, 0),
    (0, 0, 0, 0, 0, 6, 0.40, 5, 0.8, 4, 0.9, 0), (0, 0, 0, 0, 1, 25, 0.80, 30, 0.0, 28, 0.0, 0),
    (0, 0, 0, 0, 0, 10, 0.90, 20, 0.0, 40, 0.0, 0), (0, 0, 0, 0, 0, 60, 0.95, 2, 1.0, 0, 0.0, 0),
    (0, 1, 0, 0, 1, 5, 1.00, 2, 0.0, 4, 1.0, 0), (0, 1, 0, 0, 2, 2, 0.00, 30, 0.0, 4, 1.0, 0),
)


@dataclass(frozen=True)
class Tree:
    """A node splits a feature at a bound (at most: left) or, as a leaf, has a label."""
    feature: int = -1
    bound: float = 0.0
    left: Tree | None = None
    right: Tree | None = None
    label: bool = False


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Tree:
    """Splits by the least Gini impurity until the leaves are pure; ties take the earliest feature."""
    if depth == 0 or y.all() or not y.any():
        return Tree(label=bool(2 * y.sum() > len(y)))
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for bound in (values[1:] + values[:-1]) / 2:
            left = x[:, k] <= bound
            impurity = sum(2 * part.sum() * (1 - part.mean()) for part in (y[left], y[~left]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, float(bound))
    if best is None:
        return Tree(label=bool(2 * y.sum() > len(y)))
    left = x[:, best[1]] <= best[2]
    return Tree(best[1], best[2], grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


def classify(tree: Tree, x: np.ndarray) -> np.ndarray:
    if tree.left is None:
        return np.full(len(x), tree.label)
    left = x[:, tree.feature] <= tree.bound
    out = np.empty(len(x), bool)
    out[left], out[~left] = classify(tree.left, x[left]), classify(tree.right, x[~left])
    return out


def fit(labelled=LABELLED) -> Tree:
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1] == 1)


class Block(NamedTuple):
    """A block with its words, how many of them are in links, how clearly it is furniture, the content level and the kind."""
    text: str
    words: int
    linked: int
    mark: int
    level: int
    kind: int


def _named(tag: str, token: str, slug: bool) -> int:
    """What one name of an element (a class, or with ``slug`` its id) says about it."""
    parts = [p for p in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()) if p]
    quoted = tag in ("section", "blockquote", "figure", "p", "span")
    furniture = [bool(FURNITURE_PARTS.fullmatch(p)) for p in parts]
    topic = [bool(TOPIC_PARTS.fullmatch(p)) for p in parts]
    either = [bool(EITHER_PARTS.fullmatch(p)) or (quoted and p == "comment") for p in parts]
    if not (any(furniture) or any(topic) or any(either)):
        return 0
    # the id of a section is made of its heading
    if any(furniture) and not (slug and tag in ("section", *HEADINGS)):
        return FURNITURE
    pure = all(f or t or PLAIN_PARTS.fullmatch(p) for f, t, p in zip(furniture, topic, parts))
    return FURNITURE if pure and not any(either) else OPEN


def _standing(tag: str, attrs: str, mark: int, level: int) -> tuple[int, int]:
    """How clearly a container is furniture of the page, and how clearly it is the content's."""
    own = 3 if tag == "article" else 2 if tag == "main" else 0
    if own and mark < FURNITURE:
        mark = 0
    if tag in FURNITURE_TAGS or (tag == "header" and level < 2):
        mark = FURNITURE
    elif tag == "form":
        mark = max(mark, FORM)
    if attrs and mark < FURNITURE:
        if _HIDDEN.search(attrs):
            mark = FURNITURE
        elif "=" in attrs and tag not in ("main", "body", "html"):
            for name, *values in _NAMES.findall(attrs):
                value = _LAYOUT.sub(" ", "".join(values))
                if level >= 2:  # the article's own heading
                    value = _OWN_HEADER.sub(" ", value)
                for token in value.split():
                    if tag != "article":
                        mark = max(mark, _named(tag, token, name.lower() == "id"))
                    elif _OTHERS.fullmatch(token):
                        mark = FURNITURE
                    if not own and CONTENT_WORDS.search(token):
                        own = 1
    return mark, max(level, 0 if tag in ("body", "html") else own)


def blocks(page: str) -> list[Block]:
    """Every block with words, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    parts: list[str] = []
    linked: list[str] = []
    in_link, at = 0, 0
    mark, level = 0, 0
    # the last block tag: its kind, and what its own names say
    kind, own_mark = 0, 0

    def close() -> None:
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                links = len(html.unescape(" ".join(linked)).split()) if linked else 0
                out.append(Block(" ".join(words), len(words), min(links, len(words)), max(mark, own_mark), level, kind))
            parts.clear()
        linked.clear()

    while True:
        found = _TOKEN.search(page, at)
        text = page[at:found.start() if found else len(page)]
        if text:
            parts.append(text)
            if in_link:
                linked.append(text)
        if not found:
            break
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        opens = not found["close"]
        if opens and tag in SKIPPED:
            if not found["attrs"].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                # an unclosed head ends where the body begins; another unclosed element ends the page
                if not end and tag == "head":
                    end = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else (at if tag == "head" else len(page))
            continue
        if tag == "a":
            in_link = 1 if opens else 0
        if tag == "br":
            parts.append(" ")
            if in_link:
                linked.append(" ")
        if tag in BLOCK_TAGS:
            close()
            kind = 0 if not opens else 2 if tag in HEADINGS else 1 if tag in RUNNING else 0
            own_mark = 0
            if opens and tag not in CONTAINERS and found["attrs"]:
                own_mark = _standing(tag, found["attrs"], mark, level)[0]
        if tag in CONTAINERS:
            if opens and not found["attrs"].endswith("/"):
                if tag == "li" and stack and stack[-1][0] == "li":  # the item before was left open
                    _, mark, level = stack.pop()
                inner = _standing(tag, found["attrs"], mark, level)
                if tag == "span" and inner[0] != mark:
                    close()
                stack.append((tag, mark, level))
                mark, level = inner
            elif not opens:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        if tag == "span" and stack[k][1] != mark:
                            close()
                        _, mark, level = stack[k]
                        del stack[k:]
                        break
    close()
    return out


def describe(found: list[Block]) -> np.ndarray:
    """The features of a page's blocks, in page order."""
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if n:
        words = np.array([b.words for b in found], float)
        density = np.array([b.linked for b in found]) / words
        mark = np.array([b.mark for b in found])
        level = np.where(mark >= FORM, 0, [b.level for b in found])
        out[:, 0], out[:, 1] = mark >= FORM, mark == OPEN
        out[:, 2] = (np.array([b.level for b in found]) >= level.max()) & (level.max() > 0)
        out[:, 3] = level.max() > 0
        out[:, 4] = [b.kind for b in found]
        out[:, 5], out[:, 6] = words, density
        out[1:, 7], out[1:, 8] = words[:-1], density[:-1]
        out[:-1, 9], out[:-1, 10] = words[1:], density[1:]
    return out


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    keep = classify(tree, describe(found)) if found else []
    return "\n".join(block.text for block, kept in zip(found, keep) if kept)


def _extract(tree: Tree):
    def extract(batches):
        for batch in batches:
            pages = [blocks(page or "") for page in batch.column("html").to_pylist()]
            keep = classify(tree, np.concatenate([describe(page) for page in pages]))
            texts, at = [], 0
            for page in pages:
                texts.append("\n".join(block.text for block, kept in zip(page, keep[at:at + len(page)]) if kept))
                at += len(page)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])
    return extract


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Per row: page_id, url and the main text of ``html``.

    A null or empty page, and one without content, has an empty text. Pages are read one by one, so
    repeated rows agree; null ids and addresses stay null; an empty table gives no rows; other columns are
    not read. Lists of links and what stands under a heading for them are no content, one link between paragraphs is. Unclosed elements end with their container or the page.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract(tree or fit()), "page_id long, url string, text string")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
