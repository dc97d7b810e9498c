"""Labelled training pages for the block labeller, made by rule.

Pages are composed from the parts that real pages have (menus, notices, adverts,
article, comments, forms, footer) in many layouts; each main-text block starts
with MAIN, which the trainer strips. Words are drawn from random syllables, so
what the labeller can learn is where blocks stand, what their tags are called
and the phrases that belong to the frame of a page.
"""

from __future__ import annotations

import random

MAIN = "\x01"

# Names that sites give to the parts of a page, and frame phrases.
NAMES = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs main-menu site-nav pagination pager tabs",
    "head": "header site-header masthead branding logo top banner-top page-header",
    "notice": "cookie cookie-banner consent notice alert gdpr popup modal announcement warning message privacy",
    "advert": "ad ads advert advertisement sponsored promo banner adsense ad-slot commercial sponsor",
    "side": "sidebar aside widget related recommended popular tags toc trending share social more-links widgets",
    "comments": "comments comment comment-list reader-comments replies discussion disqus responses respond reactions",
    "form": "newsletter subscribe signup login search search-form contact-form subscription feedback",
    "foot": "footer site-footer bottom colophon copyright legal page-footer credits",
    "main": "content article post entry entry-content article-body story post-content main text body-text main-content",
}
PHRASES = {
    "menu": ["Home", "About us", "Contact", "News", "Sport", "Products", "Next page", "Inicio", "Accueil", "Startseite"],
    "head": ["Daily News", "The blog", "Welcome to our site", "Skip to content", "Menu", "Search"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "This site uses cookies. Learn more.",
               "By continuing you agree to our terms.", "Wir verwenden Cookies.", "Nous utilisons des cookies."],
    "advert": ["Advertisement", "Sponsored", "Buy now and save 50%", "Special offer", "Anzeige", "Publicité"],
    "side": ["Related articles", "Popular posts", "Share this", "Tags", "Follow us", "Read more", "You may also like"],
    "comments": ["3 comments", "Reply", "Leave a comment", "Comments", "Report", "Kommentare", "Log in to reply"],
    "form": ["Subscribe to our newsletter", "Email address", "Submit", "Password", "Sign up", "Search", "Send"],
    "foot": ["All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "© 2024 Example Inc.", "Contact us"],
}
TAGS = {"menu": ["nav", "div", "ul", "header"], "head": ["header", "div"], "notice": ["div", "section", "aside"],
        "advert": ["div", "aside", "section", "ins"], "side": ["aside", "div", "section"],
        "comments": ["section", "div", "ol", "aside"], "form": ["form", "div"], "foot": ["footer", "div"]}


class _Writer:
    def __init__(self, rng: random.Random):
        self.rng = rng
        self.syllables = ["".join(rng.choice(c) for c in ("bcdfghklmnprstvwzéñ", "aeiouäöè", "nrstl "))
                          .strip() for _ in range(40)]

    def words(self, lo: int, hi: int) -> str:
        rng = self.rng
        out = ["".join(rng.choices(self.syllables, k=rng.choice((1, 1, 2, 2, 3)))) for _ in range(rng.randint(lo, hi))]
        text = " ".join(w + rng.choice(("", "", "", "", ",", ".")) for w in out)
        return text[:1].upper() + text[1:] + rng.choice((".", ".", "", "!", "?"))

    def inline(self, text: str) -> str:
        words = text.split(" ")
        if len(words) > 4 and self.rng.random() < 0.4:
            k = self.rng.randrange(len(words) - 2)
            tag = self.rng.choice(("b", "em", 'a href="/x"', "strong", "span", "i"))
            words[k] = f"<{tag}>{words[k]}"
            if self.rng.random() < 0.8:
                words[k + 1] += f"</{tag.split()[0]}>"
        text = " ".join(words)
        return text.replace(" ", "<br>", 1) if self.rng.random() < 0.1 else text

    def named(self, kind: str) -> str:
        """Attributes that name the part, or none."""
        if self.rng.random() < 0.25:
            return ""
        name = self.rng.choice(NAMES[kind].split())
        return f' {self.rng.choice(("class", "class", "id"))}="{name}"'

    def frame(self, kind: str) -> str:
        """A part of the page's frame."""
        rng, tag = self.rng, self.rng.choice(TAGS[kind])
        attrs = self.named(kind)
        if not attrs and tag in ("div", "section", "ol", "ul"):
            attrs = f' class="{rng.choice(NAMES[kind].split())}"'
        parts = []
        for _ in range(rng.choice((1, 2, 3, 6))):
            text = rng.choice(PHRASES[kind]) if rng.random() < 0.4 else (
                self.words(8, 60) if kind in ("comments", "notice", "advert", "foot") and rng.random() < 0.6
                else self.words(1, 4))
            if kind == "menu" or kind == "side" and rng.random() < 0.7:
                parts.append(f'<li><a href="/{len(text)}">{text}</a></li>')
            elif kind == "form":
                parts.append(f"<label>{text}</label><input><button>{rng.choice(PHRASES[kind])}</button>")
            elif kind == "comments":
                parts.append(f'<div{rng.choice(("", " class=comment", " class=reply"))}><span>{self.words(1, 2)}'
                             f"</span><p>{self.inline(text)}</p></div>")
            else:
                parts.append(rng.choice(("{}", "<p>{}</p>", "<div>{}</div>", "<span>{}</span> ")).format(self.inline(text)))
        inner = "".join(parts)
        if kind in ("menu", "side") and tag != "ul" and "<li>" in inner:
            inner = f"<ul>{inner}</ul>"
        if kind in ("side", "comments") and rng.random() < 0.5:
            inner = f"<h3>{rng.choice(PHRASES[kind])}</h3>{inner}"
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def article(self) -> str:
        rng, out = self.rng, []
        title = self.words(1, 9)
        if rng.random() < 0.9:
            tag = rng.choice(("h1", "h1", "h1", "h2"))
            out.append(f"<{tag}>{MAIN}{title}</{tag}>")
        if rng.random() < 0.4:  # the text begins with its title
            out.append(f"<p>{rng.choice(('', '<b>'))}{MAIN}{title}<br>")
        few = rng.choice((0.15, 0.3, 0.6))
        for _ in range(rng.choice((1, 2, 3, 5, 8, 13, 25, 50))):
            r = rng.random()
            text = MAIN + self.inline(self.words(1, 6) if rng.random() < few else self.words(6, 90))
            if r < 0.6:
                out.append(f"<p>{text}</p>")
            elif r < 0.72:
                out.append(f"<p><b>{text}<br>" if rng.random() < 0.5 else f"<p>{text}")
            elif r < 0.8:
                out.append(f"<h2>{MAIN}{self.words(1, 7)}</h2>")
            elif r < 0.86:
                out.append("<ul>" + "".join(f"<li>{MAIN}{self.words(1, 15)}</li>" for _ in range(rng.randint(2, 6))) + "</ul>")
            elif r < 0.9:
                out.append(f"<blockquote>{text}</blockquote>")
            elif r < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{MAIN}{self.words(1, 3)}</td><td>{MAIN}{self.words(1, 3)}</td></tr>"
                                               for _ in range(rng.randint(1, 4))) + "</table>")
            else:
                out.append(self.frame(rng.choice(("advert", "side", "form", "notice"))))
        kind = rng.random()
        if kind < 0.45:
            attrs = self.named("main")
            return f"<article{attrs}>{''.join(out)}</article>"
        if kind < 0.6:
            return f"<main{self.named('main')}>{''.join(out)}</main>"
        if kind < 0.92:
            return f'<div class="{rng.choice(NAMES["main"].split())}">{"".join(out)}</div>'
        return "".join(out)

    def page(self) -> str:
        rng = self.rng
        before = [self.frame(k) for k in ("head", "menu", "notice", "advert", "side", "form") if rng.random() < 0.5]
        after = [self.frame(k) for k in ("side", "advert", "comments", "form", "notice", "menu") if rng.random() < 0.4]
        rng.shuffle(before)
        rng.shuffle(after)
        foot = [self.frame("foot")] if rng.random() < 0.8 else []
        body = "".join([*before, self.article() if rng.random() < 0.96 else "", *after, *foot])
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(("wrapper", "container", "page", "site"))}">{body}</div>'
        return (f"<html><head><title>{self.words(1, 9)}</title></head><body>{body}"
                + ("</body></html>" if rng.random() < 0.8 else ""))


def sample_pages(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [_Writer(rng).page() for _ in range(n)]
