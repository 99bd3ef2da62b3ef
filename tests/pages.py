"""Small hand-written pages of the layouts the operators read."""

CARD_TITLE = "Öffnet die Einzelsicht"


def card(inner: str, href: str = "FDB/Content/DE/Kontakt/a.html") -> str:
    return (f'<dd class="card"> <p class="card--title"> <a class="" title="{CARD_TITLE}" '
            f'href="{href}"> <span class="link--label"> {inner} </span> </a> </p>')


CONTACT = (
    '<dt>Ansprechpunkt:</dt> ' + card("<span>Projekt&shy;haus</span> Nord")
    + '<p class="card--title-subtitle">Filiale<br/> West</p> <div class="address"> '
    '<p class="adr"> Lange Gasse 1 </p> <p class="locality"> 12345 Ort </p> </div> '
    '<div class="person-contact"> <p class="tel"> Tel: 030 1234 </p> '
    '<p class="fax"> Fax: 030 9999 </p> <p class="email"> <a href="mailto:info@haus.example"> '
    '<svg class="icon"> <use xlink:href="#m"></use> </svg> <span class="link--label">mail</span>'
    '</a> </p> <p class="website"> <a target="_blank" href="https://haus.example/"> '
    '<svg/> <span class="link--label">Haus</span> </a> </p> </div> </dd> '
)
LINKS = (
    '<dt class="document-info-item">Weiterführende Links:</dt> <dd> '
    '<a class="link" href="https://eins.example/a?b=1&amp;c=2"> <span>Eins</span> </a> '
    '<a class="link" href="/zwei/seite.html">Zwei</a> '
    '<a class="link" href="drei.html">Drei</a> <a name="kein">ohne</a> </dd> '
)


def page(dl: str, content: str, h1: str = '<h1 class="title"> Titel A &amp; B </h1>') -> str:
    return (
        '<!DOCTYPE html><html lang="de"><head><title>x & y</title>'
        '<script>var t="</p><dt>";</script></head><body><header><h1>Portal</h1></header>'
        '<main class="main"> <div class="jumbotron"> <div class="container"> '
        f'<div class="content"> <p class="content--topline">F</p> {h1} </div> </div> '
        f'<div class="container"> <div class="content"> {dl} </div> </div> </div> '
        f'<div class="container content--main"> {content} </div> </main></body></html>'
    )


def tabs(*pairs) -> str:
    return '<div class="content"> <div class="rich--text"> ' + " ".join(
        f'<h2 class="opener"> <span class="btn--label">{name}</span> </h2> '
        f'<article class="content--tab-text">{body}</article>' for name, body in pairs
    ) + " </div> </div>"


def dl(*pairs) -> str:
    return "<dl>" + "".join(f"<dt> {k}: </dt> <dd> {v} </dd> " for k, v in pairs) + "{more}</dl>"


TABBED = page(
    dl(("Förderart", "Zuschuss"), ("Förderbereich", "Beratung, Bau & Wohnen, Energie"),
       ("Fördergebiet", " "), ("Unbekannt", "x"), ("Förderart", "Darlehen, Zuschuss"))
    .replace("{more}", "<dt>Fördergeber:</dt> "
             + card("Ministerium für Wasser (MfW)") + "</dd> " + CONTACT + LINKS),
    tabs(("Kurzzusammenfassung", "<p>Kurz &amp; gut</p>"), ("Zusatzinfos ", "<p>Mehr<p>Noch mehr"),
         ("Seltsam", "<p>weg</p>"), ("Rechtsgrundlage", "<h3>Recht</h3><ul><li>eins<li>zwei</ul>")),
)
FALLBACK = page(
    "", '<div class="content"> <div class="rich--text"> <p> Nur <div>Text</div></div> </div>'
    '<aside>Service</aside>', '<h1 class="title"><span>Titel</span> C</h1>')
UNTITLED = page("", '<div class="content">x</div>', "<h1>Titel ohne Klasse</h1>")
EMPTY = page("", "<p>nichts</p>", '<h1 class="title">Leer</h1>')
BROKEN = '<html><body><main><h1 class="title">Abgebrochen <b>mitten'

LISTING = (
    '<html><body><div class="card card--horizontal card--fundingprogram"><p class="card--title">'
    '<a href="FDB/Content/DE/Foerderprogramm/Bund/a.html?b=2&amp;a=1#top">A</a></p></div>'
    '<div class="card--fundingprogram"><p class="card--title"><a href="/FDB/b.html"><i>B</i></a>'
    '</p></div><div class="card--fundingprogram"><p class="card--title"><a>C</a></p></div>'
    '<div class="card"><p class="card--title"><a href="no.html">no</a></p></div>'
    '<a class="button is forward" href="?page=2">weiter</a></body></html>'
)
LAST_LISTING = (
    '<html><body><div class="card--fundingprogram"><p class="card--title">'
    '<a href="https://X.example/FDB/b.html">B again</a></p></div>'
    '<a class="forward button" href="">weiter</a></body></html>'
)
