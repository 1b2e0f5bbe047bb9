"""Template residue, filler, error pages and scripts-required notices.

Method: the labelled exemplars below stand in an inverted index. A text that holds the
rarest terms of an exemplar is cut into passage windows (lines, sentences, table cells,
bracketed spans), and each window is held against the retrieved exemplars by TF-IDF
containment in both directions: how much of the exemplar the window holds, and how much
of the window the exemplar covers. Text that only speaks of an error page covers little. A sentence
of its own that the exemplars of one category cover together, one of them by half, counts as well, so
that messages in other words are found. Written forms such as ``{{x}}`` are exemplars with a slot.

Defined results: null and empty texts are no residue; code spans in backticks and names of
environment variables are blanked first; whole texts are read, however long; further columns are carried along.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled exemplars by category. ``*`` stands for any run of words.
EXEMPLARS: dict[str, list[str]] = {
    "placeholder": [
        "TODO", "TODO: *", "FIXME: *", "TBD: *", "TODO: fill in *", "TODO: complete *", "TODO : compléter *", "TODO: completare *", "TODO: * ergänzen",
        "TBD", "TBD - to be completed by the owner of *", "to be completed by the owner of *", "To be completed",
        "À compléter par le responsable (*)", "À compléter", "Wird noch ausgefüllt (*)", "Wird noch ausgefüllt", "Noch auszufüllen",
        "Da completare a cura del responsabile (*)", "Da completare (*)", "Da completare", "Da compilare", "n/a (to do)", "xxx", "…", "...",
        "[TBD]", "[...]", "[…]", "[TODO]", "[offen]", "[à définir]", "[da definire]", "[to be defined]", "[noch offen]", "[à compléter]", "[da completare]",
        "[enter *]", "[add *]", "[choose *]", "[eingeben *]", "[saisir *]", "[compilare *]", "Untitled document", "Unbenannte Seite", "Page sans titre", "Pagina senza titolo", "[insert service name]", "[insert *]", "[Name of the component]", "[name of the service]", "[service name]", "[your *]",
        "[Dienstnamen einsetzen]", "[* einsetzen]", "[* einfügen]", "[Name des Dienstes]", "[Name der Komponente]",
        "[insérer le nom du service]", "[insérer *]", "[nom du service]", "[nom du composant]", "[inserire il nome del servizio]", "[inserire *]", "[nome del servizio]", "[nome del componente]",
        "<Service Name>", "<your-component>", "<your *>", "<Name des Dienstes>", "<Nom du service>", "<Nome del servizio>", "<component name>", "<insert *>",
        "«service»", "«Dienst»", "«servizio»", "«service name»", "{SERVICE}", "{DIENST}", "{SERVIZIO}", "{SERVICE_NAME}",
        "Untitled section", "Untitled", "Ohne Titel", "Sans titre", "Senza titolo", "Insert title here", "Überschrift einsetzen", "Titel einsetzen", "Insérer le titre ici", "Insérer un titre", "Inserire il titolo", "Inserire qui il titolo",
        "<Heading>", "<Title>", "<Überschrift>", "<Titel>", "<Titre>", "<Titolo>", "[Section title]", "[Abschnittstitel]", "[Titre de la section]", "[Titolo della sezione]", "[Heading]", "[Title]",
        "{{*}}", "${*}", "%*%", "@@*@@",
        "[PLACEHOLDER]", "Placeholder", "Placeholder text", "Your text here", "Enter text here", "Insert text here", "Add your text here", "Text goes here", "Title goes here", "Type here", "Coming soon", "Under construction",
        "This page is under construction.", "Content to follow", "To be determined", "To be defined", "To be announced", "TBA", "FIXME", "Fill in *", "<to be completed>", "[to be filled in]",
        "Platzhalter", "Platzhaltertext", "[Platzhalter]", "Hier Text einfügen", "Text hier einfügen", "Titel hier einfügen", "Inhalt folgt", "Folgt in Kürze", "Noch zu ergänzen", "Diese Seite ist im Aufbau.",
        "Texte à insérer", "Insérer votre texte ici", "Votre texte ici", "À venir", "À définir", "Bientôt disponible", "Page en construction", "Espace réservé",
        "Segnaposto", "Testo segnaposto", "Inserire il testo qui", "Il tuo testo qui", "Da definire", "Prossimamente", "Disponibile a breve", "Pagina in costruzione",
        "Marcador de posición", "Próximamente", "Por completar", "Insertar texto aquí", "Su texto aquí", "Sin título",
        "New page (copy of template)", "Neue Seite (Kopie der Vorlage)", "Nouvelle page (copie du modèle)", "Nuova pagina (copia del modello)", "copy of template",
    ],
    "guidance": [
        "Describe * here.", "[Describe * here.", "Delete this text before publishing.", "Hier * beschreiben.", "[Hier * beschreiben.", "Diesen Text vor der Freigabe löschen.",
        "Décrire ici *", "[Décrire ici *", "Supprimer ce texte avant publication.", "Descrivere qui *", "[Descrivere qui *", "Cancellare questo testo prima della pubblicazione.",
        "Guidance: list * in this section, then remove the guidance.", "Guidance: *, then remove the guidance.", "Guidance: *", "Instructions for authors: *", "Note to author: *", "Template note: *",
        "Remove this text before publishing.", "Remove this note before publishing.", "Remove this paragraph before the page is published.", "Delete this section if it does not apply.", "Explain * here.", "List * here.", "Enter * here.", "Provide * here.", "Replace this text with *", "Use this section to describe *",
        "Hinweis für Autoren: *", "Diesen Hinweis vor der Veröffentlichung entfernen.", "Diesen Absatz vor dem Veröffentlichen löschen.", "Diesen Abschnitt löschen, falls nicht zutreffend.", "Hier * auflisten.", "Hier * eintragen.", "Diesen Text ersetzen durch *",
        "Consigne pour l’auteur : *", "Supprimer cette consigne avant publication.", "Supprimer cette section si elle ne s’applique pas.", "Lister ici *", "Expliquer ici *", "Remplacer ce texte par *",
        "Istruzioni per l’autore: *", "Rimuovere questa nota prima della pubblicazione.", "Eliminare questo paragrafo prima di pubblicare.", "Eliminare questa sezione se non applicabile.", "Elencare qui *", "Spiegare qui *", "Sostituire questo testo con *",
        "<Add a short description of *>", "<Kurze Beschreibung von *>", "<Ajouter une courte description de *>", "<Aggiungere una breve descrizione di *>",
        "Click here to enter text about *", "Click here to enter text.", "Klicken Sie hier, um Text einzugeben *", "Hier klicken, um Text einzugeben *", "Cliquez ici pour saisir du texte *", "Cliquez ici pour taper du texte *", "Fare clic qui per immettere testo *",
        "Replace this paragraph with a summary: *", "Replace this paragraph by a summary: *", "Diesen Absatz durch eine Zusammenfassung ersetzen: *", "Remplacer ce paragraphe par un résumé : *", "Sostituire questo paragrafo con un riassunto: *", "Sostituire questo paragrafo con una sintesi: *",
    ],
    "filler": [
        "Lorem ipsum dolor", "Lorem ipsum",
        "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua ut enim ad minim veniam quis nostrud exercitation "
        "ullamco laboris nisi ut aliquip ex ea commodo consequat duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur excepteur sint "
        "occaecat cupidatat non proident sunt in culpa qui officia deserunt mollit anim id est laborum",
        "Sample text.", "Sample text. Type your own *", "Type your own *", "Mustertext, bitte * eintragen.", "Beispieltext, bitte * eintragen.", "Blindtext", "Mustertext",
        "Texte d’exemple, saisir *", "Texte d’exemple", "Testo di esempio, inserire *", "Testo di esempio", "The quick brown fox jumps over the lazy dog",
    ],
    "error": [
        "404 Not Found", "404 - Page not found", "Page not found", "Not found", "Error 404", "404 - Seite nicht gefunden", "Seite nicht gefunden", "404 - Page introuvable", "Page introuvable", "404 - Pagina non trovata", "Pagina non trovata",
        "The page you asked for was moved or never existed.", "Oops! We cannot find that page.", "We cannot find that page.", "The requested page could not be found.", "Die gewünschte Seite wurde verschoben.", "La page demandée a été déplacée.", "La pagina richiesta è stata spostata.",
        "Access denied", "Access denied (code 0)", "Access denied: *", "You do not have permission to view *", "You have no permission to view *", "You have no permission to access *", "Error 403: you have no permission to view *", "Error 403: you have no permission to access *", "403 Forbidden", "Forbidden", "401 Unauthorized", "Zugriff verweigert", "Zugriff verweigert: *", "Zugriff verweigert (Code 0)", "Accès refusé", "Accès refusé : *", "Accesso negato", "Accesso negato: *",
        "Gateway Timeout", "408 Request Timeout", "Request timed out.", "400 Bad Request", "Bad request", "410 Gone", "This page does not exist.", "This page no longer exists.", "The page cannot be displayed.", "We could not find the page you were looking for.",
        "The file you requested was not found on this server.", "An error occurred while processing your request.", "An error has occurred.", "An internal error occurred.", "Sorry, an error occurred.", "The server is temporarily unavailable.", "The server encountered an error.", "Failed to load content.", "Could not load the page.",
        "You are not authorized to access this page.", "You must be logged in to view this page.", "Login required", "Please log in to continue.", "Your login has expired.", "This content is not available.", "Connection refused", "The server did not respond.",
        "Diese Seite existiert nicht.", "Die Seite wurde nicht gefunden.", "Die angeforderte Seite konnte nicht gefunden werden.", "Ein Fehler ist aufgetreten.", "Ein interner Fehler ist aufgetreten.", "Bitte versuchen Sie es später erneut.", "Sie haben keine Berechtigung, diese Seite anzuzeigen.", "Bitte melden Sie sich an.", "Zeitüberschreitung der Anfrage", "Der Server ist nicht erreichbar.",
        "La page n’existe pas.", "Cette page n’existe plus.", "La page que vous cherchez est introuvable.", "Une erreur est survenue.", "Une erreur interne s’est produite.", "Veuillez réessayer plus tard.", "Réessayer ultérieurement.", "Vous n’avez pas l’autorisation d’afficher cette page.", "Veuillez vous connecter.", "Délai d’attente dépassé", "Le serveur ne répond pas.",
        "Questa pagina non esiste.", "La pagina cercata non è stata trovata.", "Si è verificato un errore.", "Si è verificato un errore interno.", "Riprovare più tardi.", "Non si dispone dell’autorizzazione per visualizzare questa pagina.", "Effettuare l’accesso.", "Richiesta scaduta", "Il server non risponde.",
        "Your session is not valid.", "Log in again to view this content.", "You do not have access to this page.", "Sie haben keinen Zugriff auf diese Seite.", "Accès non autorisé à cette page.", "Non hai accesso a questa pagina.",
        "Página no encontrada", "La página no existe.", "Acceso denegado", "Se ha producido un error.", "Inténtelo de nuevo más tarde.",
        "Internal Server Error.", "500 Internal Server Error", "502 Bad Gateway", "Bad Gateway", "503 Service Unavailable", "Service temporarily unavailable", "Service unavailable", "504 Gateway Timeout", "Try again later.", "Please try again later.",
        "Interner Fehler, Vorgang 0 abgebrochen.", "Erreur interne, opération 0 interrompue.", "Errore interno, operazione 0 interrotta.", "Request 0 could not be completed.", "incident reference 0", "An unexpected error occurred *", "Something went wrong *",
        "Too many requests. Slow down and retry in 0 seconds.", "Too many requests.", "Slow down and retry in 0 seconds.",
        "Unable to render this macro: the linked page is not available.", "Unable to render *", "Error rendering macro *", "This site cannot be reached, the connection timed out.", "The connection timed out.",
        "Your session has expired. Please sign in again to continue.", "Your session has expired.", "Please sign in again to continue.", "Die Sitzung ist abgelaufen. Bitte erneut anmelden.", "Die Sitzung ist abgelaufen.", "Bitte erneut anmelden.",
        "La session a expiré. Veuillez vous reconnecter.", "La session a expiré.", "Veuillez vous reconnecter.", "La sessione è scaduta. Accedere di nuovo.", "La sessione è scaduta.", "Accedere di nuovo.",
        "Der Inhalt konnte nicht geladen werden.", "Le contenu n’a pas pu être chargé.", "Impossibile caricare il contenuto.", "Il contenuto non può essere caricato.", "The content could not be loaded.",
        "Dienst vorübergehend nicht verfügbar", "Service temporairement indisponible", "Servizio temporaneamente non disponibile",
    ],
    "scripts": [
        "Your browser does not support JavaScript.", "This page requires JavaScript.", "This site needs JavaScript to work.", "This application needs JavaScript to run.", "JavaScript muss eingeschaltet sein.", "JavaScript must be enabled in your browser.", "Enable JavaScript and cookies to continue.", "Scripts are disabled in your browser.",
        "Ihr Browser unterstützt kein JavaScript.", "Diese Seite benötigt JavaScript.", "JavaScript ist deaktiviert.", "Votre navigateur ne prend pas en charge JavaScript.", "Cette page nécessite JavaScript.", "JavaScript est désactivé.",
        "Activate JavaScript in your browser to see this content.", "JavaScript in Ihrem Browser einschalten, um den Inhalt zu sehen.", "Aktivieren Sie JavaScript, um fortzufahren.", "Activer JavaScript dans le navigateur pour continuer.", "Abilitare JavaScript per continuare.", "Per usare questo sito attivare JavaScript nel browser.",
        "Il browser non supporta JavaScript.", "Questa pagina richiede JavaScript.", "JavaScript è disattivato.", "Su navegador no admite JavaScript.", "Debe habilitar JavaScript para ver esta página.",
        "JavaScript required", "JavaScript is required *", "JavaScript is disabled. Some content cannot be shown.", "JavaScript is disabled.", "Some content cannot be shown.", "You need to enable JavaScript to run this app.", "Please enable JavaScript *",
        "Please turn on JavaScript in your browser and reload the page.", "This diagram viewer needs scripts; your browser has them switched off.", "This diagram viewer needs scripts", "your browser has them switched off",
        "Checking your browser before you proceed. This requires scripting and cookies.", "Checking your browser before you proceed.", "This requires scripting and cookies.", "Please activate scripting to see *",
        "Bitte JavaScript aktivieren, um diese Seite anzuzeigen.", "JavaScript erforderlich", "Diese Ansicht benötigt Skripte, die im Browser abgeschaltet sind.", "Veuillez activer JavaScript pour afficher cette page.", "JavaScript requis",
        "Cette vue nécessite des scripts désactivés dans le navigateur.", "Attivare JavaScript per visualizzare questa pagina.", "JavaScript richiesto", "Questa vista richiede script, disattivati nel browser.",
    ],
}
#: words of a sentence that says a message in other words, at most
JOINT_WORDS = 14
#: stands for a slot's words while an exemplar is cut into terms
SLOT = "slotslot"
#: categories whose messages may be put in other words
MESSAGES = ("guidance", "error", "scripts")
# Variables of an environment, which a text may name in a form that placeholders have.
ENVIRONMENT = ["HOME", "PATH", "USER", "USERNAME", "PWD", "SHELL", "TMP", "TEMP", "TMPDIR", "LANG", "HOSTNAME", "APPDATA", "PROGRAMFILES", "SYSTEMROOT", "USERPROFILE", "JAVA_HOME"]

_CODE_SPAN = re.compile(r"``[^\n]*?``(?!`)|`[^`\n]+`")
_VARIABLE = re.compile(rf"\$\{{(?:{'|'.join(ENVIRONMENT)})\}}|%(?:{'|'.join(ENVIRONMENT)})%")
_FORM = r"\{\{[^{}\n]{1,60}\}\}|\$\{[^{}\n]{1,60}\}|(?<![\w%])%[A-Z][A-Z_]{2,30}%(?![\w%])|(?<![\w@])@@[A-Z][A-Z_]{1,30}@@(?![\w@])|(?<![\w-])X{4,}(?![\w-])"
_SPAN = re.compile(_FORM + r"|(?<![\w\]\[])\[[^\[\]\n|]{2,160}\](?![\[(:\w])|(?<![\w/])<[^\W\d_][^<>\n=]{2,160}>|«[^«»\n]{2,40}»|(?<![\w/{$])\{[A-Z][A-Z_]{2,30}\}")
_TOKEN = re.compile(r"n/a|(?<![^\W_])(?:todo|fixme|tbd)(?=\s?:)\s?:|[^\W_]+|…|\.\.\.|\{\{|\}\}|\$\{|@@|(?<![\w%])%(?=[^\W\d_])|(?<=[^\W\d_])%(?![\w%])|[\[\]<>«»{}]")
_SENTENCE = re.compile(r"(?<=[.!?;])[ \xa0]+")
_MARKS = re.compile(r"^[\s>#*+-]*(?:\d+[.)]\s+)?")
_X = re.compile(r"x{3,}\Z")


def tokens(text: str) -> list[str]:
    out = []
    for t in _TOKEN.findall(text.lower()):
        if not t.isalpha() and any(c.isdigit() for c in t) and not (t.isdigit() and len(t) == 3):
            t = "0"
        elif _X.match(t):
            t = "xxx"
        out.append(t.replace(" ", "").replace("\xa0", ""))
    return out


class ResidueIndex:
    """An inverted index of exemplars with TF-IDF weights."""

    def __init__(self, exemplars: dict[str, list[str]] = EXEMPLARS, exemplar_share: float = 0.8, window_share: float = 0.75, anchors: int = 2, joint_share: float = 0.9, half: float = 0.5):
        self.exemplar_share, self.window_share, self.joint_share, self.half = exemplar_share, window_share, joint_share, half
        self.items: list[tuple[str, list[str], int, Counter]] = []
        for kind, texts in exemplars.items():
            for text in texts:
                slot = text.find("*")
                head = len(tokens(text[:slot] + SLOT)) - 1 if slot >= 0 else -1
                toks = [t for t in tokens(text.replace("*", SLOT)) if t != SLOT]
                self.items.append((kind, toks, head, Counter(toks)))
        df = Counter(t for _, toks, _, _ in self.items for t in set(toks))
        n = len(self.items)
        self.idf = {t: math.log(1 + n / d) for t, d in df.items()}
        self.unknown = math.log(1 + n / 2)
        self.postings: dict[str, list[int]] = defaultdict(list)
        self.vocab: dict[str, set[str]] = defaultdict(set)  # by category, for messages in other words
        for kind, toks, _, _ in self.items:
            if kind in MESSAGES:
                self.vocab[kind].update(t for t in toks if t.isalnum())
        self.totals = []
        self.long_totals = [sum(self.idf[t] * c for t, c in counts.items() if len(t) >= 4) for _, _, _, counts in self.items]
        self.anchors = []
        for i, (_, toks, _, counts) in enumerate(self.items):
            self.totals.append(sum(self.idf[t] * c for t, c in counts.items()))
            if self._long_filler(i):  # a part of it is enough, so each of its longer words leads to it
                self.anchors.append(frozenset())
                for t in counts:
                    if len(t) >= 5:
                        self.postings[t].append(i)
                continue
            best = sorted(set(toks), key=lambda t: (t.isalnum() and len(t) < 5, -self.idf[t], -len(t), t))[:anchors]  # short words stand in most texts
            self.anchors.append(frozenset(best))
            self.postings[best[0]].append(i)
            if self.reworded(i):  # any of its longer words may lead to it
                for t in counts:
                    if len(t) >= 5 and t != best[0]:
                        self.postings[t].append(i)
        self._bounds()

    def _bounds(self) -> None:
        """What windows need at most: words that some exemplar may cover, but for running filler text."""
        short = [len(toks) for i, (_, toks, _, _) in enumerate(self.items) if not self._long_filler(i)]
        self.longest = 2 * max(short) + 16
        self.filler_terms = {t for t, held in self.postings.items() if any(self._long_filler(i) for i in held)}

    def known_words(self, low: str) -> bool:
        """Whether almost all words of a sentence stand in exemplars, so that they may cover it."""
        words = low.split()
        return sum(w.strip(".,;:!?()") not in self.idf for w in words) <= 1 + len(words) // 4

    def reworded(self, i: int) -> bool:
        """Whether exemplar ``i`` is a sentence that may be put in other words."""
        kind, toks, head, _ = self.items[i]
        return kind in MESSAGES and head < 0 and len(toks) >= 4

    def _jointly(self, counts: Counter, weight: float, i: int) -> bool:
        """Whether the longer words of exemplar ``i`` are held by half and its category covers the whole sentence."""
        if not self.reworded(i) or not 4 <= sum(counts.values()) <= JOINT_WORDS:
            return False
        kind, _, _, wanted = self.items[i]
        if sum(self.idf[t] * min(c, counts.get(t, 0)) for t, c in wanted.items() if len(t) >= 4) < self.half * self.long_totals[i]:
            return False
        known = self.vocab[kind]
        return sum(self.idf[t] * c for t, c in counts.items() if t in known) >= self.joint_share * weight

    def _long_filler(self, i: int) -> bool:
        kind, toks, head, _ = self.items[i]
        return kind == "filler" and head < 0 and len(toks) > 20

    def terms(self) -> set[str]:
        """The terms that lead from a text to an exemplar."""
        return set(self.postings)

    def score(self, window: list[str]) -> str | None:
        """The category of the best exemplar that covers the window and is held by it."""
        leads = [t for t in window if t in self.postings]
        if not leads:
            return None
        counts = Counter(window)
        weight = sum(self.idf.get(t, self.unknown) * c for t, c in counts.items())
        for term in dict.fromkeys(leads):
            for i in self.postings[term]:
                kind, toks, head, wanted = self.items[i]
                held = sum(self.idf[t] * min(c, counts.get(t, 0)) for t, c in wanted.items())
                if not self.anchors[i] <= counts.keys():
                    if self._jointly(counts, weight, i):
                        return kind
                    continue
                if head >= 0:  # words in a slot are free, but the window has to begin as the exemplar does
                    if held >= self.exemplar_share * self.totals[i] and window[:head] == toks[:head] and len(window) <= len(toks) + 16:
                        return kind
                elif held >= self.window_share * weight and (held >= self.exemplar_share * self.totals[i] or (self._long_filler(i) and len(window) >= 5)):
                    return kind
                if self._jointly(counts, weight, i):
                    return kind
        return None

    def windows(self, text: str) -> Iterator[str]:
        for line in text.split("\n"):
            line = line.strip()
            if not line:
                continue
            if line.startswith("|"):
                yield from (c.strip() for c in line.strip("|").split("|"))
                continue
            body = _MARKS.sub("", line)
            yield body
            parts = _SENTENCE.split(body)
            if len(parts) > 1:
                yield from parts
                yield from (" ".join(parts[i : i + 2]) for i in range(len(parts) - 1) if len(parts) > 2)
        for m in _SPAN.finditer(text):
            yield m.group(0)

    def classify(self, text: str | None, leads: tuple[set[str], set[str]] | None = None) -> str | None:
        """The category of the text's first residue, or None. ``leads``: the terms that the retriever found."""
        if not text:
            return None
        if "`" in text:
            text = _CODE_SPAN.sub(" ", text)
        if "$" in text or "%" in text:
            text = _VARIABLE.sub(" ", text)
        for window in self.windows(text):
            if leads is not None:
                low = window.lower()
                if low.count(" ") > self.longest and not leads[0] & self.filler_terms:  # no exemplar covers so long a window
                    continue
                # A sentence in other words has at most JOINT_WORDS, all of which exemplars have.
                if not any(t in low for t in leads[0]) and (low.count(" ") > 2 * JOINT_WORDS or not any(t in low for t in leads[1]) or not self.known_words(low)):
                    continue
            toks = tokens(window)
            if toks and (kind := self.score(toks)):
                return kind
        return None


class Retriever:
    """Finds the texts that hold the leading term of some exemplar, in one pass over the text."""

    def __init__(self, index: ResidueIndex):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for t in index.terms():
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.index = index
        # Of each exemplar, the terms that a text may lack as far as the share allows.
        self.wanted = [[(t, index.idf[t] * c) for t, c in counts.items() if t != "0"] for _, _, _, counts in index.items]
        self.slack = [(1 - index.exemplar_share) * total + 1e-9 for total in index.totals]
        self.long = [[(t, index.idf[t] * c) for t, c in counts.items() if len(t) >= 4] if index.reworded(i) else [] for i, (_, _, _, counts) in enumerate(index.items)]
        self.long_slack = [(1 - index.half) * total + 1e-9 for total in index.long_totals]

    def leads(self, text: str) -> tuple[set[str], set[str]]:
        """The leading terms in the text whose exemplars it may hold, and those whose exemplars it may hold in other words."""
        low = text.lower()
        whole, reworded = set(), set()
        for t in {t for _, t in self.automaton.iter(low)}:
            for i in self.index.postings[t]:
                if self.long[i] and sum(w for a, w in self.long[i] if a not in low) > self.long_slack[i]:
                    continue  # says less than all its terms, which need no look then
                if self.index._long_filler(i) or sum(w for a, w in self.wanted[i] if a not in low) <= self.slack[i]:
                    whole.add(t)
                    break
                if self.long[i]:
                    reworded.add(t)
        return whole, reworded


_STATE: dict = {}


def detector():
    """The index and its retriever, built once in a Python worker."""
    if "d" not in _STATE:
        index = ResidueIndex()
        _STATE["d"] = (index, Retriever(index))
    return _STATE["d"]


def residue_kind(text: str | None) -> str | None:
    index, retriever = detector()
    return index.classify(text, leads) if text and any(leads := retriever.leads(text)) else None


def residue_rows(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose ``text`` holds residue, with its category in ``residue``; the text falls away."""
    keys = [c for c in rows.columns if c != text]
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != text) + ", residue string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kinds = [residue_kind(t) for t in pdf[text]]
            at = [i for i, k in enumerate(kinds) if k]
            if at:  # an empty selection has no Arrow chunk to send
                yield pd.DataFrame({c: pdf[c].to_numpy(dtype=object)[at] for c in keys} | {"residue": [kinds[i] for i in at]})

    return rows.where(F.col(text).isNotNull() & (F.length(text) > 0)).mapInPandas(run, schema)


def residue_records(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """(rec_kind, doc_id, rec_id, residue) of sections by title and of blocks, but for code, by text."""
    titles = sections.select(F.lit("section").alias("rec_kind"), "doc_id", F.col("section_id").alias("rec_id"), F.col("title").alias("text"))
    texts = blocks.where(F.coalesce(F.col("content_type") != "code", F.lit(True))).select(F.lit("block").alias("rec_kind"), "doc_id", F.col("block_id").alias("rec_id"), "text")
    return residue_rows(titles.unionByName(texts)).groupBy("rec_kind", "doc_id", "rec_id").agg(F.min("residue").alias("residue"))
