"""Whether a sentence is what a server, a script shell or an empty template says instead of a page's author.

A sentence is judged by cues: a word of general use on such pages, and a phrase around it. Most sentences have no such
word and cost one set lookup. A sentence with a cue is still content when it explains (gives a reason, a definition, an
example) or when most of its words are about something else; what stands in quotes or in code marks is mentioned, not
said. Sentences such as "try again later" are no evidence of their own, and no content either.
"""

from __future__ import annotations

import re
from collections import Counter

CONTENT, NEUTRAL, EVIDENCE = 0, 1, 2

# Fixed values: (words of a cue, phrase that must be there as well), in English, German, Spanish and French.
ERROR = (
    (("error", "errors", "fehler", "erreur", "errores"), r"^(?:\W*\w+\W+){0,3}(?:errors?|fehler|erreur|errores)\b(?: (?:has |ist |est )?(?:occurred|aufgetreten|survenue)(?: while processing your request)?)?"),
    (("http", "https"), r"\bhttps? (?:error |status )?\d+\b"),
    (("denied", "refused", "forbidden", "prohibido", "interdit", "verweigert", "denegado", "refusé", "verboten"), r"\b(?:access|permission|connection|request|acc[eè]so?|zugriff|zugang|permiso)\b.*\b(?:denied|refused|forbidden|prohibido|interdit|verweigert|denegado|refusé|verboten)\b|^forbidden\b"),
    (("unauthorized", "unauthorised", "unauthenticated"), ""),
    (("rights", "permission", "permissions", "authorized", "authorised", "allowed", "access"), r"(?:\b(?:lack|not have|no|not|without|insufficient)|n't have)\b.{0,30}\b(?:rights|permissions?|authori[sz]ed|allowed|access)\b"),
    (("find",), r"(?:\bnot|n't|\bunable to) find\b.{0,20}\b(?:page|file|site|content|document)\b"),
    (("found", "gefunden", "trouvé", "trouvée", "encontrada", "encontrado", "encontramos"), r"\b(?:not|n[o']t|be|nicht|no|non|pas|se)\b.{0,20}\b(?:found|gefunden|trouvée?|encontrad[ao]|encontramos)\b"),
    (("introuvable",), ""),
    (("exist", "exists", "existiert", "existe", "gibt"), r"\b(?:no longer|not|n't) exists?\b|\bexistiert\b.*\bnicht\b|\bgibt es (?:hier )?nicht\b|\b(?:ya )?no existe\b|n'existe (?:pas|plus)"),
    (("here",), r"\b(?:is|are|was|were)(?: not|n't) here\b|\bnot here\b"),
    (("missing",), r"(?:^|: |\bhere )(?:page|file|resource|document) missing\b|^missing (?:page|file|resource)\b"),
    (("moved", "removed", "deleted", "renamed", "suspended", "disabled", "deactivated"), r"\b(?:page|file|content|account|site|address|link|resource|you)\b.*\b(?:been|was|is|were) (?:temporarily |permanently )?(?:re)?(?:moved|deleted|renamed|suspended|disabled|deactivated)\b|^account (?:suspended|disabled)"),
    (("unavailable", "indisponible"), ""),
    (("available", "disponible", "verfügbar", "erreichbar"), r"\b(?:not|no longer|isn't|no|ya no|nicht|pas|plus)\b.{0,20}\b(?:available|disponible|verfügbar|erreichbar)\b"),
    (("offline", "down", "maintenance", "upkeep", "wartung", "mantenimiento"), r"\b(?:site|page|service|server|system|we|sitio|seite|servicio)\b.*\b(?:offline|down|maintenance|upkeep|wartung|mantenimiento)\b"),
    (("timeout", "timed"), r"\b(?:connection|gateway|request|read|server|operation) timeout\b|\btimed out\b"),
    (("gateway", "upstream"), r"\b(?:bad gateway|gateway (?:timeout|error)|(?:gateway|upstream) (?:said|gave|did|returned|failed))\b"),
    (("respond", "answer", "response"), r"\b(?:not|n't|no|any) (?:respond|answer|response)\b"),
    (("unable", "cannot", "couldn", "failed", "impossible"), r"(?:^|[:,] |\b(?:we|was|were|is|are|page|site|server|it|video|content) )(?:unable to|cannot|could not|couldn't|failed to|impossible de) (?:be )?(?:connect|reach|reached|load|loaded|open|process|complete|resolve|display|displayed|establish|charger|afficher)\b"),
    (("establishing", "interrupted", "reset"), r"\bconnection\b.*\b(?:reset|interrupted|closed|lost)\b"),
    (("wrong", "broke", "broken", "schiefgelaufen"), r"\b(?:something|anything|etwas) (?:has |have |ist )?(?:gone |went )?(?:wrong|broke|broken|schiefgelaufen)\b"),
    (("working", "work"), r"\b(?:page|site|service)\b.*\b(?:isn't|is not|not) working\b"),
    (("failure", "exception", "traceback", "misconfiguration"), r"\bfailure\b|\b(?:un\w+|\w+-side|fatal|an?) exception\b|\btraceback \(|\bmisconfiguration\b"),
    (("keyerror", "valueerror", "typeerror", "runtimeerror", "nullpointerexception"), r"\b(?:raised|threw|caused)\b|^\w+:"),
    (("many", "viele", "demasiadas", "trop"), r"\btoo many (?:requests|attempts|redirects|connections)\b|\bzu viele anfragen\b|\bdemasiadas solicitudes\b|\btrop de requêtes\b"),
    (("limit", "quota", "rate"), r"\b(?:rate|usage|request) limit\b.*\b(?:reached|exceeded)\b|\bexceeded\b.*\b(?:limit|quota|rate)\b"),
    (("expired", "abgelaufen", "caducado", "expiré", "session", "sesión", "sitzung"), r"\b(?:session|link|login|token|sesión|sitzung)\b.*\b(?:expired|run out|timed out|ended|abgelaufen|caducado|expiré|expirado)\b|\bexpired (?:session|link|login|token)\b"),
    (("blocked", "gesperrt", "bloqueado", "bloqueada", "bloqué"), r"\b(?:you|your|access|ip|account|ihre?|su|acceso|votre|accès)\b.*\b(?:blocked|gesperrt|bloquead[oa]|bloqué)\b"),
    (("human", "robot", "captcha"), r"\b(?:prove|verify|confirm|are|check|checking)\b.*\bhuman\b|\bnot a robot\b|\bcaptcha\b"),
    (("checking",), r"\bchecking\b.*\byour (?:browser|connection)\b"),
    (("sign", "log", "login"), r"^(?:please )?(?:sign|log) ?in (?:again |first )?(?:to (?:go on|continue|view|see|proceed)|again)\b"),
    (("logged",), r"\bbeen logged out\b"),
    (("fehlgeschlagen",), ""),
    (("check",), r"\bsecurity check\b"),
    (("bad", "invalid"), r"\b(?:bad|invalid) request\b"),
    (("oops", "whoops"), ""),
)
SCRIPT = (
    (
        ("javascript", "js", "scripting"),
        r"\b(?:enabled?|disabled|turn(?:ed)? o[nf]f?|switch(?:ed)? o[nf]f?|activat\w*|allow(?:ed)?|requires?|required|needs?|must|without|support|blocked|off|aktivier\w*|schalten|ein|erforderlich|benötigt|ohne|activ(?:e|ar|er|ez)|habilit\w+|necesit\w+|requier\w+|sin|sans|nécessit\w+|requis|browsers? with)\b",
    ),
    (("scripts", "skripte"), r"\b(?:without|blocked|allow|enabled?|disabled|turn(?:ed)? on|switch(?:ed)? on|ohne|sin|sans)\b"),
    (("loading", "chargement", "cargando"), r"^(?:loading|chargement|cargando)(?: page| content)?$"),
)
FILLER = (
    (("tbd", "tba", "todo"), r"^(?:tbd|tba|todo)\b"),
    (("do",), r"^to do\b"),
    (("soon", "próximamente", "bientôt"), r"^(?:\w+ ){0,3}coming soon\b|^próximamente|\bbientôt\b"),
    (("construction", "construcción", "aufbau", "progress"), r"\bunder construction\b|\ben construc(?:tion|ción)\b|\bim aufbau\b|^work in progress\b"),
    (("pending", "added", "written", "announced", "follow", "come", "venir", "filled"), r"\b(?:content|text|description|copy|details|section|page|contenu|texte)\b.*\b(?:pending|to be (?:added|written|announced|filled)|to (?:follow|come)|à venir)\b"),
    (("here", "aquí", "hier", "ici"), r"\bgoes here\b|\b(?:text|content|copy|texto|texte) (?:here|aquí|hier|ici)\b|\byour[ -](?:\w+[ -]){0,2}here\b"),
    (("sample", "dummy", "placeholder", "example", "platzhalter"), r"\b(?:sample|dummy|placeholder) (?:text|paragraph|content|copy|page|sentence)\b|\bis an? (?:example page|placeholder)\b|^platzhalter"),
    (("replaced", "replace"), r"^replace (?:this|it|me)\b|\bwill be replaced\b"),
    (("blank", "empty", "leer"), r"\b(?:left|is|been) (?:intentionally |deliberately )?(?:left )?(?:blank|empty)\b|\babsichtlich leer\b"),
    (("describe", "add", "insert", "put", "write", "enter", "type"), r"\b(?:describe|add|insert|put|write|enter|type)\b.*(?:\bhere\b|\bbelow$|\btext about\b|\bsentences?\b)"),
)
#: What stands beside a message.
NEUTRAL_CUES = (
    (("reference", "ref", "incident", "request", "trace", "ray", "code", "id", "case", "vorgang", "referenz", "código", "dossier", "référence"), r"\b(?:reference|ref|incident|request|trace|ray|code|id|case|vorgang|referenz|código|dossier|référence)\b[ :#]*(?:id |no |number )?[ :#]*(?=[a-z.-]*\d)[0-9a-z.-]{3,}$"),
    (("again", "later", "back", "soon", "home", "start", "später", "erneut", "tarde", "intentarlo", "tard", "réessayer", "zurück", "inicio", "accueil", "retour", "wieder"), r"\b(?:try|come|check|slow|go|back|return|we|please|bitte|versuchen|zurück|später|schauen|inténtelo|vuelva|volver|más tarde|plus tard|revenez|retour|veuillez)\b"),
    (("address", "url", "spelling", "connection", "network"), r"\b(?:check|verify)\b|\bnetwork change\b"),
    (("owner", "support", "administrator", "webmaster", "provider", "us"), r"\b(?:write|contact|call|email|ask|notify|quote)\b"),
    (("told", "notified", "informed"), r"\b(?:we|team|administrators?)\b"),
    (("wait", "moment", "sorry", "inconvenience", "reload", "refresh"), r"\b(?:please|one|just|we|sorry|inconvenience|reload|refresh|page|bitte)\b"),
    (("allow", "enable", "permettez"), r"^(?:please )?(?:allow|enable) (?:it|them)\b"),
    (("line",), r"^at line \d+"),
    (("nginx", "apache", "cloudflare"), r"^\w+(?:[/ ][\d.]+)?$"),
    (("continue", "proceed", "console"), r"\b(?:to|can) (?:continue|proceed)$|\bbrowser console\b"),
)
#: Words of the printers' mock-Latin passage that no language of the texts uses in this company.
MOCK_MARKS = frozenset(("lorem", "ipsum"))
MOCK_LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in "
    "reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui "
    "officia deserunt mollit anim id est laborum".split()
)
#: Words without a subject of their own.
FUNCTION = frozenset(
    "a an the this that these those it its we us our you your they them their he she i me my is are was were be been am has have had do does did will would can could may might must shall "
    "not no of to in on at by for from with without and or but if as so than then before after there here up out off about into over under again also more most all any some each every only just now please "
    "der die das den dem des ein eine einen einer es wir sie ihre ihr ist sind war wird werden kann und oder nicht auf zu um mit für von im diese dieser dieses hier nichts "
    "el la los las un una lo su se es está son fue y o no de del al en para por con sin que este esta aquí nada "
    "t re s ll ve d l n qu don doesn isn aren wasn couldn won le les une il elle nous vous votre est sont et ou ne pas du des au aux en pour par avec sans que ce cette ici rien".split()
)
#: What messages are about.
SITE = frozenset("page pages site website web app application browser server service network host address account database viewer seite sitio página aplicación navegador servicio page application navigateur serveur".split())
#: What an explanation has.
_EXPLAINS = re.compile(r"\b(?:means?|meaning|such as|for example|which|whose|explains?|explained|describes|described|is (?:shown|used|called)|always|the word|bedeutet|zum beispiel|welche\w?|erklärt|significa|por ejemplo|signifie|par exemple|ce qui)\b")
_REASON = re.compile(r"\b(?:because|since|when|as long as|although|even though|unless|if the|so that|weil|denn|wenn|porque|cuando|parce que|quand)\b")
_ADDRESS = re.compile(r"\b(?:you|your|we|our|sie|ihr|ihre|usted|su|vous|votre|nous)\b")
_MENTION = re.compile(r"\"[^\"]*\"|“[^”]*”|«[^»]*»|„[^“”]*[“”]|`[^`]*`")
_QUOTES = re.compile("[\"`“«„]")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\w+")
_STATUS = re.compile(r"[1-5]\d\d\b(?=$|\W*\s)")
_CRUMB = " \t\r.!?:;,()[]{}'\"*_`~-–—…>|#+"


def _by_word(*groups: tuple) -> dict[str, list[tuple[int, re.Pattern[str]]]]:
    found: dict[str, list[tuple[int, re.Pattern[str]]]] = {}
    for group in groups:
        kind = NEUTRAL if group is NEUTRAL_CUES else EVIDENCE
        for words, phrase in group:
            for w in words:
                found.setdefault(w, []).append((kind, re.compile(phrase or rf"\b{w}\b")))
    return found


_CUES = _by_word(ERROR, SCRIPT, FILLER, NEUTRAL_CUES)
_CUE_WORDS = frozenset(_CUES)


def repeats(words: list[str]) -> bool:
    """A few words over and over, with little else."""
    return len(words) >= 3 and sum(n for n in Counter(words).values() if n >= 3) >= 0.6 * len(words)


def mock(words: list[str], marked: bool) -> bool:
    """Mock Latin: mostly words of the passage, or beside its marks, words among which no language's small ones are."""
    own = sum(w in MOCK_LATIN for w in words)
    if own >= 3 and own > 0.6 * len(words) and any(len(w) > 4 and w in MOCK_LATIN for w in words):
        return True
    return marked and len(words) >= 2 and all(w in MOCK_LATIN or w not in FUNCTION for w in words)


def monotone(words: list[str]) -> bool:
    """Words of no known language drawn from a small stock: no small words, and far fewer different ones than any prose of that length has."""
    return len(words) >= 12 and FUNCTION.isdisjoint(words) and len(set(words)) <= 3 * len(words) ** 0.5


def words_of(sentence: str) -> list[str]:
    """The lower-case words of a sentence; what has digits is a number or a reference, and no word."""
    return [w for w in _TOKEN.findall(sentence.lower()) if w.isalpha()]


def judged(sentence: str, marked: bool = False) -> int:
    """CONTENT, NEUTRAL or EVIDENCE. marked: the text around it is known to be mock Latin."""
    s = sentence.lower().strip(_CRUMB)
    words = words_of(s)
    if not words:
        return EVIDENCE if s[:1] in ("4", "5") and _STATUS.fullmatch(s) else NEUTRAL
    best, covered = CONTENT, set()
    if s[0] in "45" and _STATUS.match(s) and len(words) <= 6:
        best = EVIDENCE
    if cues := _CUE_WORDS.intersection(words):
        if _QUOTES.search(s):
            s = _MENTION.sub(" ", s)
        if _EXPLAINS.search(s) or (_REASON.search(s) and not _ADDRESS.search(s)):
            return CONTENT
        for w in cues:
            for kind, phrase in _CUES[w]:
                if m := phrase.search(s):
                    best = max(best, kind)
                    covered.update(_WORD.findall(m[0]))
                    covered.add(w)
    often = {w for w, n in Counter(words).items() if n >= 3}
    if best == CONTENT:
        if repeats(words) or mock(words, marked or not MOCK_MARKS.isdisjoint(words)):
            return EVIDENCE
        # words over and over, and then a sentence without anything between
        ends = [s.rfind(w) + len(w) for w in often - FUNCTION]
        return EVIDENCE if ends and repeats(words_of(s[: max(ends)])) and judged(s[max(ends) :].lstrip(_CRUMB + "0123456789"), marked) != CONTENT else CONTENT
    foreign = sum(w not in covered and w not in FUNCTION and w not in SITE and w not in often for w in words)
    return best if foreign <= 3 or foreign <= 0.4 * len(words) else CONTENT
