"""Template residue, filler copy, failed values, error pages and script notices where an issue's own words should be.

A field is split into its lines (a subject is one line), and every line is masked: blanks collapse, numbers, dates, web and
mail addresses become classes, letters lower case. Equal masked lines are one message, whatever the source. All messages are
grouped by the exact hash of their mask with the distinct sources that show them; nothing is left out before.

1. A message that stands in WIDELY or more sources is classified by broad rules on one line of it: any pair of placeholder
   delimiters, phrases with slots ("your ... here"), or a line made almost wholly of the words of notices, of which one names
   what failed and one how. No source writes such a line by itself, so no list of the very phrases is needed.
2. Any line, however rare, is residue by the narrower rules: delimiters of template languages, names of fields, values that
   failed to render, filler copy, sure phrases at its start.

Placeholder rules read a line anywhere but inside code quotes. Lines that write about such things do so within a longer
sentence or in quotes, and match neither.

Only hashes are shuffled, never texts: of each recurring message one place is looked up again. Defined results: null and empty
fields and fields without a key are no case; a field is listed once however many of its lines are residue; texts and placeholders are scanned whole,
whatever their length; messages of unknown source count as no source; an empty table gives none.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.plans.durable import durable, join_counted

#: A message recurs widely if it stands in so many distinct sources.
WIDELY = 3
#: Stands for a null name.
NO_NAME = "\u0000"
#: Tables are broadcast up to so many rows.
BROADCAST_ROWS = 200_000

# Names of the fields that mailing tools fill in.
FIELD_NAMES = (
    "first_?name", "last_?name", "full_?name", "f_?name", "l_?name", "user_?name", "reader_?name", "name", "vorname", "nachname", "pr[eé]nom", "nom", "nombre", "apellido", "email", "e-?mail", "city", "ort", "ville", "ciudad",
    "company", "firma", "entreprise", "empresa", "subject", "betreff", "headline", "title", "date", "issue_?date", "edition(?:_?no)?", "issue(?:_?no)?", "sponsor[ _]copy", "ad[ _]copy", "insert [a-z ]+", "story\\.link", "user\\.[a-z]+", "unsubscribe(?:_?(?:url|link))?", "link", "url",
)
NAME = f"(?:{'|'.join(FIELD_NAMES)})"
ID = r"[a-zà-ÿ_][\wà-ÿ.]*(?: [a-zà-ÿ_][\wà-ÿ.]*)?"
# Placeholder delimiters of common mailing tools and template languages. Where ordinary text uses the same
# signs, the known field names must stand between them.
NAMED = (rf"(?<![\w$])\${NAME}\$(?!\w)", rf"(?<!\w)%{NAME}%(?!\w)")
PLACEHOLDERS = (
    r"\{\{[^{}\n]+\}\}", r"\{%-?\s*[a-z]\w*[^%\n]*%\}", r"<%[^%\n]+%>", rf"\$\{{\s*{ID}\s*\}}", rf"#\{{\s*{ID}\s*\}}", rf"\{{\$?{ID}\}}", r"\*\|[^|\n]+\|\*",
    rf"%%{ID}%%", rf"%\({ID}\)[sd]", rf"@@{ID}@@", rf"##{ID}##", *NAMED, rf"<<\s*{ID}\s*>>", rf"«\s*{NAME}\s*»", rf"(?<!\w)__{ID}__(?!\w)",
    r"\[\[[^\[\]\n]+\]\]", rf"\[{NAME}\]", r"\[(?:insert|your|placeholder|add|enter) [^\]\n]+\]", r"\[(?:[^\[\]\n]*\W)?TK\]", r"<!-- ?(?:drop|insert|put|place|add|todo|begin|start)\b[^\n]*?-->",
)
# Values that failed to render.
FAILED = (
    r"\[object object\]", r"^(?:dear|hi|hello|hey|hallo|hola|bonjour|good (?:morning|day|evening)),? (?:null|undefined|none|nan)\b", r"^undefined\s*:", r":\s*(?:undefined|null|nan|none)[°%]?\s*(?:$|[,.;])", r"\bnull null\b", r"\byour nan\b", r"\bfor (?:undefined|null|nan)\W*$", r"\bnan[°%]",
    r"^\s*(?:null|undefined|nan|none)\s*$", r"(?:^|[\s(–-])tk ?tk(?: tk)*(?:$|[\s).,–-])", r"\b(?:xxx+|tbd|todo)\s*:?\s*(?:headline|subject|copy|text)",
)
# Filler copy.
FILLER = (
    r"\blorem ipsum dolor sit\b", r"^\W*texte de remplacement\W*$", r"^\W*your (?:caption|text|headline|title|copy|image|logo|story|subject) (?:goes )?here\W*$", r"^\W*hier steht (?:ihr|dein|der) text\W*$", r"^\W*(?:aquí va (?:su|tu|el) texto|votre texte ici|texto de relleno|blindtext)\W*$",
    r"^\W*(?:body|headline|intro|main)? ?(?:text|copy|headline|content) goes here\b", r"^\W*(?:body|headline|intro|main) (?:text|copy) (?:goes )?here\b", r"\bheadline \(9 (?:characters|chars|words) max\)", r"^\W*this (?:block|section|space|paragraph) is left blank\b", r"^\W*(?:insert|replace) (?:this|your) (?:text|paragraph|copy)\b", r"^\W*test (?:subject|headline|e?-?mail)\W*$",
    r"^\W*insert (?:subject|headline|title|text|copy|name) here\b", r"^\W*(?:copy of )*template\b[^a-z0-9]*do not send\b", r"^\W*(?:copy of )+template\b", r"^\W*xx+ placeholder\b", r"\bplaceholder (?:subject|headline|text|copy|title)\b[^a-z]*(?:x+)?\W*$",
)
#: Words of the customary Latin filler; a line made of little else is filler.
LATIN = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum nunc vel"
#: A line of at least so many words, of which this share is Latin filler.
LATIN_WORDS, LATIN_SHARE = 4, 0.75
# Notices that fill a line from its start, in the mask's form.
SURE = (
    r"please (?:enable|turn on|activate) (?:javascript|scripts|cookies)\b", r"(?:javascript|scripts?) (?:is|are) (?:disabled|turned off|switched off|not enabled)\b", r"(?:javascript|scripts?) (?:is|are) required(?:\W*$| (?:to|for) )", r"bitte (?:javascript|skripte) aktivieren\b", r"your browser (?:has (?:scripts|javascript) (?:switched|turned) off|does not support (?:javascript|scripts))", r"you need to enable (?:javascript|scripts)\b", r"we use scripts to show\b", r"javascript ist deaktiviert\b",
    r"bitte aktivieren sie javascript\b", r"esta página necesita javascript\b", r"(?:cette page|ce site) nécessite javascript\b", r"veuillez activer javascript\b", r"this (?:page|site|email|issue) (?:requires|needs) (?:javascript|scripts)\b",
    r"(?:error |http )?9(?: -)? (?:not found|forbidden|bad gateway|service unavailable|internal server error|gateway time-?out|too many requests|unauthorized|gone)\W*$", r"(?:the|this) (?:requested )?page (?:could not be found|does not exist|cannot be found|you requested)\b", r"access denied\W*$", r"(?:service|server|site|page) (?:is )?(?:temporarily |currently )?unavailable\W*$", r"page introuvable\b", r"(?:error|fehler|erreur) 9\W+(?:page not found|seite nicht gefunden|not found)", r"(?:your )?session (?:has )?expired\b", r"you do(?: not|n[’']t) have permission to (?:view|access)\b", r"the upstream server did not answer\b",
    r"error 9: [a-z ]+(?:unreachable|timed? ?out|refused|failed)\b", r"error code: 9\b", r"something went wrong\W", r"we couldn[’']t load (?:this|the)\b", r"checking your browser before\b", r"too many requests\W", r"cette page n[’']existe plus\b", r"der server ist derzeit nicht erreichbar\b", r"die seite (?:wurde nicht gefunden|existiert nicht)\b", r"(?:esta|la) página no (?:existe|se encuentra|está disponible)\b",
    r"uncaught (?:type|reference|syntax|range)?error\b", r"fatal error: [a-z]", r"traceback \(most recent call last\)", r"(?:template|render(?:ing)?) error\b", r"exception in thread\b", r"prove that you are human\b", r"verify (?:that )?you are (?:a )?human\b", r"this content is not available in your (?:region|country)\b", r"sign in to continue\W",  r"down for maintenance\b",
)
GENERAL = (r"nginx\W*$", r"ray(?: id)?:? 9\W*$", r"reference #9\W*$", r"one more step\W*$", r"this may take up to 9 seconds\b", r"request id:? 9\W*$", r"forbidden\W*$", r"not found\W*$", r"bad gateway\W*$", r"service unavailable\W*$", r"an error (?:has )?occurred\W*$")


# Words of notices by their part, in English, German, French and Spanish: what failed, how, and the words between.
WHAT = set(
    "javascript js script scripts skript skripte browser browsers cookie cookies server servers serveur servidor page pages seite seiten página paginas site sites website webseite session sitzung sesión request requests anfrage anfragen "
    "gateway connection verbindung connexion conexión host origin network access zugriff accès acceso error errors fehler erreur content inhalt inhalte contenu contenido resource resources robot robots bot bots human captcha blocker blockers service services dienst "
    "application plugin extension navigateur navegador requête solicitud".split()
)
HOW = set(
    "enable enabled enabling activate activated allow allowed disable disabled deactivated blocked blocking off missing required requires require needs needed necessary denied forbidden unavailable unreachable unauthorized unauthorised expired failed failure "
    "refused timeout timed exceeded invalid broken unable unsupported maintenance overloaded down reload refresh refreshing retry again found prove verify checking wrong must cannot can't couldn't didn't doesn't isn't won't "
    "aktivieren aktiviert deaktiviert erforderlich benötigt verweigert abgelaufen gefunden erreichbar verfügbar blockiert fehlgeschlagen erlauben zulassen "
    "activer activez activé désactivé requis nécessite nécessaire introuvable expirée expiré refusé indisponible bloqué interdit actualisez réessayez échoué autoriser "
    "activar active activado desactivado requiere necesita necesario encontrada encontrado disponible denegado caducado caducada bloqueado falló permitir recargue reintente".split()
)
BETWEEN = set(
    "a an the this that these those your you we us our it its it's they them is are was be been being has have had having do does did not no nor could can will would should may to for of on in into at by with within without from and or but if unless then so before after "
    "while when until as because please later now here there back all any some other more moments moment seconds second minutes minute few try trying wait contact support administrator message messages mail email e-mail letter letters issue issues newsletter edition text article story view "
    "display displayed displaying displays show shows shown showing see seen read load loads loaded loading open opened continue proceed visit go work works working run runs properly correctly fully first use uses using used turn turned switch switched on in out up reach reached "
    "answer answered respond responded response complete completed process processed requested upstream internal temporarily currently too many bad slow device settings window tab ad ads region country permission time status code id something "
    "bitte sie ihr ihre ihrem ihren der die das den dem des ein eine einen einer ist sind war wird werden wurde nicht kein keine und oder um zu zur zum in im auf an für von mit diese dieser dieses diesen fortzufahren fortfahren anzuzeigen anzeigen derzeit leider später erneut noch einmal sehen lesen ausgabe nachricht ihrer neu laden existiert mehr existieren "
    "veuillez le la les l un une des de du d cette ce cet ces votre vos est sont été n' ne pas plus ou et pour dans sur avec cette continuer afficher lire actuellement plus tard existe déplacée trouvée demandée message numéro "
    "por favor el los las una de del en este esta estos su sus es son fue no ya y o para con sin continuar ver leer mostrar actualmente más tarde existe solicitada funcionar mensaje número".split()
)
#: A line of a notice has at least so many words, of which this share is known, one of WHAT and one of HOW among them.
NOTICE_WORDS, NOTICE_SHARE = 2, 0.75
# Invitations to read the issue elsewhere, which are no notice; what a slot of filler copy holds.
ELSEWHERE = r"\b(?:view|read|open|see|trouble|ansehen|öffnen|lesen|voir|lire|ouvrir|ver|leer|abrir)\b.*\b(?:browser|navigateur|navegador|online|web)\b|\bbrowser (?:ansehen|öffnen|lesen)\b"
SLOT = "(?:headline|subhead|caption|text|copy|subject|title|paragraph|image|picture|photo|logo|body|intro|teaser|blurb|button|link|cta|byline|placeholder|content|überschrift|betreff|titel|bild|absatz|titre|texte|légende|título|texto|imagen|pie)"
FIELD_LIKE = r"(?:(?:first|last|full|user|reader)[ _-]?name|name|vorname|nachname|pr[eé]nom|nom|nombre|apellido|e-?mail|insert|placeholder|goes here|tbd|tk|einfügen|insérer|insertar)"
#: Broad rules for messages that recur widely: any pair of delimiters, with a field between signs that texts use too.
WIDE_PLACES = (
    r"<<[^<>\n]+>>", r"\{[^{}\n]*\p{L}[^{}\n]*\}", r"\[\[[^\[\]\n]+\]\]", r"%%[^%\n]+%%", r"##[^#\n]*\p{L}[^#\n]*##", r"@@[^@\n]+@@", r"(?<!\w)__[^_\n]*\p{L}[^\n]*?__(?!\w)", r"\*\|[^|\n]+\|\*", r"\|\|[^|\n]*\p{L}[^|\n]*\|\|", r"<%[^%\n]+%>", r"<!--[^\n]*?-->",
    rf"\[(?:[^\[\]\n]*\W)?{FIELD_LIKE}(?:\W[^\[\]\n]*)?\]", rf"«(?:[^»\n]*\W)?{FIELD_LIKE}(?:\W[^»\n]*)?»", rf"<(?:[^<>\n]*\W)?{FIELD_LIKE}(?:\W[^<>\n]*)?>", rf"(?<!\w)%(?:[^%\n]*\W)?{FIELD_LIKE}(?:\W[^%\n]*)?%(?!\w)",
)
WIDE_FILLER = (
    rf"^\W*(?:insert|replace|put|add|enter|type|write|drop|paste|place)\b[^.!?:]*\b{SLOT}\b[^.!?:]*\b(?:here|below|before sending)\b", rf"^\W*(?:your|ihr|ihre|dein|deine|votre|su|tu) (?:\w+ ){{0,2}}{SLOT} (?:goes |comes |kommt |va )?(?:here|hier|ici|aquí)\W*$",
    rf"^\W*(?:\w+ ){{0,2}}{SLOT} (?:goes|comes|kommt|steht|va|to go) (?:here|hier|ici|aquí)\b", rf"^\W*(?:placeholder|dummy|sample|filler|platzhalter|default)\W+(?:\w+ ){{0,2}}{SLOT}\W*$", rf"^\W*(?:\w+ ){{0,2}}{SLOT}\W+(?:placeholder|to come|tbd|tba|tk|9 (?:characters|chars|words) max)\W*$",
)

MASKS = ((r"https?://\S+|www\.\S+", "⟨url⟩"), (r"[\w.+-]+@[\w-]+\.[\w.-]+", "⟨mail⟩"), (r"\d{4}-\d{2}-\d{2}", "⟨date⟩"), (r"\d+(?:[.,]\d+)*+", "9"))
CODE_QUOTED = r"`[^`\n]*`"

_PLACE = "(?i)" + "|".join(PLACEHOLDERS)
_WIDE_PLACE = "(?i)" + "|".join((*PLACEHOLDERS, *WIDE_PLACES))
#: Of every placeholder one of these signs is a part.
_SIGNS = r"[{\[<%$#@*«_]"
_ALL_VALUES = (*FAILED, *FILLER)
# rules that are tied to the start of a line are tried at one place only; the others have one of these words in every match
_LEAD = r"^\W*"
_AT_START = "(?i)" + "|".join((f"{_LEAD}(?:{'|'.join(x.removeprefix(_LEAD) for x in _ALL_VALUES if x.startswith(_LEAD))})", *(x for x in _ALL_VALUES if x.startswith("^") and not x.startswith(_LEAD))))
_ANYWHERE = "(?i)" + "|".join(x for x in _ALL_VALUES if not x.startswith("^"))
_HINTS = ("undefined", "null", "nan", "none", "object", "tk", "xxx", "tbd", "todo", "lorem", "headline (", "placeholder")
_SURE = "^\\W{0,4}(?:" + "|".join(SURE) + ")"
_GENERAL = "^\\W{0,4}(?:" + "|".join(GENERAL) + ")"
# by first letters, so that few branches are tried at a word
_LATIN = rf"\b(?:{'|'.join(f'{c}(?:{chr(124).join(w[1:] for w in group)})' for c, group in groupby(sorted(LATIN.split()), lambda w: w[0]))})\b"


def plain(line: Column) -> Column:
    """A line without what stands in code quotes and with its blanks collapsed."""
    shown = F.when(F.contains(line, F.lit("`")), F.regexp_replace(line, CODE_QUOTED, "`")).otherwise(line)
    return F.trim(F.regexp_replace(shown, r"\s{2,}|[^\S ]", " "))  # single blanks need no replacement


def masked(flat: Column) -> Column:
    """The message of a plain line: numbers, dates, addresses as classes, lower case. Each class is looked for only where it can be."""
    (url, url_by), (mail, mail_by), *digits = MASKS
    out = F.when(F.contains(flat, F.lit("http")) | F.contains(flat, F.lit("www.")), F.regexp_replace(flat, url, url_by)).otherwise(flat)
    out = F.when(F.contains(flat, F.lit("@")), F.regexp_replace(out, mail, mail_by)).otherwise(out)
    numbered = out
    for pattern, by in digits:
        numbered = F.regexp_replace(numbered, pattern, by)
    return F.lower(F.when(flat.rlike(r"\d"), numbered).otherwise(out))


def _latin_share(mask: Column) -> Column:
    words = F.split(F.trim(F.regexp_replace(mask, r"[^a-z ]+", "")), " +")
    return F.when(F.size(words) >= LATIN_WORDS, F.size(F.filter(words, lambda w: w.isin(LATIN.split()))) / F.size(words)).otherwise(F.lit(0.0))


def own_kind(flat: Column, mask: Column) -> Column:
    """What a line is by the narrow rules, whoever else shows it: placeholder, failed, filler, notice or null."""
    hint = F.contains(mask, F.lit(_HINTS[0]))
    for w in _HINTS[1:]:
        hint = hint | F.contains(mask, F.lit(w))
    return (
        F.when(flat.rlike(_SIGNS) & flat.rlike(_PLACE), "placeholder").when(mask.rlike(_AT_START) | (hint & mask.rlike(_ANYWHERE)), "failed")
        .when(mask.rlike(_LATIN) & (_latin_share(mask) >= LATIN_SHARE), "filler").when(mask.rlike(_SURE), "notice")
    )


def wide_kind(flat: Column, mask: Column) -> Column:
    """What a message is that stands in many sources, by the broad rules; null if it is an ordinary line."""
    words = F.filter(F.split(F.replace(mask, F.lit("’"), F.lit("'")), r"[^\p{L}'-]+"), lambda w: w.rlike(r"\p{L}") & ~w.isin("url", "mail", "date"))
    known = F.size(F.filter(words, lambda w: w.isin(sorted(WHAT | HOW | BETWEEN)))) / F.size(words)
    has = lambda of: F.exists(words, lambda w: w.isin(sorted(of)))
    notice = (F.size(words) >= NOTICE_WORDS) & (known >= NOTICE_SHARE) & has(WHAT) & has(HOW) & ~mask.rlike(ELSEWHERE)
    return (
        F.when(flat.rlike(_WIDE_PLACE), "placeholder").when(mask.rlike(_AT_START) | mask.rlike(_ANYWHERE), "failed").when(mask.rlike("(?i)" + "|".join(WIDE_FILLER)) | (_latin_share(mask) >= LATIN_SHARE), "filler")
        .when(mask.rlike(_SURE) | mask.rlike(_GENERAL) | notice, "notice")
    )


def lines_of(fields: DataFrame, key: str, name: str, text: str) -> DataFrame:
    """(key, name, line_no, message, own) of every line that is not blank: the hash of its mask and its kind by the narrow rules."""
    lines = fields.filter(F.length(text) > 0).select(key, name, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    flat = lines.filter(~F.trim("line").isin("", "\r")).select(key, name, "line_no", plain(F.col("line")).alias("flat"))
    both = flat.select(key, name, "line_no", "flat", masked(F.col("flat")).alias("mask"))
    return both.select(key, name, "line_no", F.xxhash64("mask").alias("message"), own_kind(F.col("flat"), F.col("mask")).alias("own"))


def _small(written: DataFrame) -> DataFrame | None:
    """A written table, marked for broadcast if its counted rows are few."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else None


def wide_messages(lines: DataFrame, fields: DataFrame, sources: DataFrame, key: str, name: str, text: str, source: str) -> tuple[DataFrame, int]:
    """(message, n, kind) of the messages in WIDELY or more sources that are residue, and the rows of all wide messages.

    One line of each message is looked up again, by its place, and classified."""
    shown = lines.select(key, "message").join(sources.filter(F.col(source).isNotNull()).select(key, F.xxhash64(source).alias("s")), key)
    wide = shown.groupBy("message", "s").agg(F.count(F.lit(1)).alias("n")).groupBy("message").agg(F.count(F.lit(1)).alias("sources"), F.sum("n").alias("n")).filter(F.col("sources") >= WIDELY)
    wide = durable(wide.select("message", "n"))
    rows = int(wide.agg(F.sum("n")).first()[0] or 0)
    small = _small(wide)
    hits = lines.join(small, "message") if small is not None else join_counted(lines, wide, "message", "n", rows)
    places = durable(hits.groupBy("message").agg(F.min(F.struct(key, name, "line_no")).alias("p"), F.first("n").alias("n")).select("message", "n", "p.*"))
    few = _small(places)
    at = fields.join(few if few is not None else places, [key, name]).select("message", "n", plain(F.try_element_at(F.split(text, "\n"), F.col("line_no") + 1)).alias("flat"))
    # several deliveries may write a field differently: the hash tells which of them it was
    same = at.withColumn("mask", masked(F.col("flat"))).filter(F.xxhash64("mask") == F.col("message")).dropDuplicates(["message"])
    return durable(same.select("message", "n", wide_kind(F.col("flat"), F.col("mask")).alias("kind")).filter("kind IS NOT NULL")), rows


def residue(fields: DataFrame, sources: DataFrame, key: str = "msg_id", name: str = "field_name", text: str = "text", source: str = "source") -> DataFrame:
    """One row per field that holds residue: (key, name, kinds as a sorted array, recurring, by_rule).

    sources has one source of each key. recurring tells that a message which stands in many sources is among the reasons,
    by_rule that a narrow rule is.
    """
    # other columns may have our names; a null name is a name of its own
    fields, sources = fields.filter(F.col(key).isNotNull()).select(key, F.coalesce(name, F.lit(NO_NAME)).alias(name), text), sources.select(key, source)
    lines = durable(lines_of(fields, key, name, text))
    wide, rows = wide_messages(lines, fields, sources, key, name, text, source)
    small = _small(wide)
    known = lines.select(key, name, "message")
    recurring = (known.join(small, "message") if small is not None else join_counted(known, wide, "message", "n", rows)).select(key, name, "kind", F.lit(True).alias("recurring"))
    own = lines.filter("own IS NOT NULL").select(key, name, F.col("own").alias("kind"), F.lit(False).alias("recurring"))
    both = recurring.unionByName(own)
    return both.groupBy(key, F.nullif(name, F.lit(NO_NAME)).alias(name)).agg(F.array_sort(F.collect_set("kind")).alias("kinds"), F.bool_or("recurring").alias("recurring"), F.bool_or(~F.col("recurring")).alias("by_rule"))
