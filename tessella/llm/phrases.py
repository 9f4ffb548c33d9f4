"""Texts that the residue models are trained on, generated from small grammars of general usage in Spanish, English and
Portuguese, from the status phrases of the HTTP standard (Python's own table), and from rules for keyboards, repeated
words and made-up Latin. Nothing here is taken from a corpus that is judged."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from http import HTTPStatus

#: Latin of the public domain: Cicero (De finibus 1, 32, the source of the printers' usual filler; Catilina 1), Caesar, Virgil, Ovid, Livy, the Vulgate.
LATIN = (
    "Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam eaque ipsa quae ab illo inventore "
    "veritatis et quasi architecto beatae vitae dicta sunt explicabo. Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia "
    "consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt. Neque porro quisquam est qui dolorem ipsum quia dolor sit amet consectetur adipisci velit, "
    "sed quia non numquam eius modi tempora incidunt ut labore et dolore magnam aliquam quaerat voluptatem. Ut enim ad minima veniam, quis nostrum exercitationem "
    "ullam corporis suscipit laboriosam, nisi ut aliquid ex ea commodi consequatur. Quis autem vel eum iure reprehenderit qui in ea voluptate velit esse quam nihil "
    "molestiae consequatur, vel illum qui dolorem eum fugiat quo voluptas nulla pariatur. At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis "
    "praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident.",
    "Quo usque tandem abutere, Catilina, patientia nostra? Quam diu etiam furor iste tuus nos eludet? Quem ad finem sese effrenata iactabit audacia? Nihilne te nocturnum "
    "praesidium Palati, nihil urbis vigiliae, nihil timor populi, nihil concursus bonorum omnium, nihil hic munitissimus habendi senatus locus, nihil horum ora voltusque moverunt?",
    "Gallia est omnis divisa in partes tres, quarum unam incolunt Belgae, aliam Aquitani, tertiam qui ipsorum lingua Celtae, nostra Galli appellantur. Hi omnes lingua, "
    "institutis, legibus inter se differunt. Gallos ab Aquitanis Garumna flumen, a Belgis Matrona et Sequana dividit. Horum omnium fortissimi sunt Belgae, propterea quod a cultu "
    "atque humanitate provinciae longissime absunt, minimeque ad eos mercatores saepe commeant atque ea quae ad effeminandos animos pertinent important.",
    "Arma virumque cano, Troiae qui primus ab oris Italiam fato profugus Laviniaque venit litora, multum ille et terris iactatus et alto vi superum, saevae memorem Iunonis ob iram, "
    "multa quoque et bello passus, dum conderet urbem inferretque deos Latio; genus unde Latinum Albanique patres atque altae moenia Romae.",
    "In nova fert animus mutatas dicere formas corpora; di, coeptis, nam vos mutastis et illas, adspirate meis primaque ab origine mundi ad mea perpetuum deducite tempora carmen. "
    "Ante mare et terras et quod tegit omnia caelum unus erat toto naturae vultus in orbe, quem dixere chaos, rudis indigestaque moles.",
    "Facturusne operae pretium sim si a primordio urbis res populi Romani perscripserim nec satis scio nec, si sciam, dicere ausim, quippe qui cum veterem tum volgatam esse rem videam.",
    "In principio creavit Deus caelum et terram. Terra autem erat inanis et vacua, et tenebrae erant super faciem abyssi, et spiritus Dei ferebatur super aquas. Dixitque Deus: Fiat lux. "
    "Et facta est lux. Et vidit Deus lucem quod esset bona, et divisit lucem a tenebris. Appellavitque lucem diem et tenebras noctem.",
)
#: Inflections of Latin words.
ENDINGS = "um us a ae am is it at et unt ent ant are ere ire ibus orum arum que os es em o or ur tur".split()
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890")
LONE_WORDS = "texto text palabra word prueba test teste ejemplo example exemplo bla blah foo bar baz aaa bbb abc xyz xxx zzz".split()

#: Grammars: slots are parted by `;`, choices by `|`; every combination is a sentence.
FILLER = (
    "Escriba|Escribe|Ingrese|Introduzca|Inserte|Agregue|Añada|Redacte|Coloque|Pegue;aquí;el texto|su texto|su título|su comentario|su mensaje|su nombre|un párrafo|una descripción",
    "Su|Tu;texto|título|contenido|imagen|logo|descripción;aquí|va aquí|irá aquí",
    "Aquí;va|irá|debe ir|se escribe;el texto|su texto|el título|una imagen|un párrafo",
    "Haga clic|Haz clic|Pulse|Presione;aquí para|para;agregar|añadir|editar|modificar|insertar|escribir;un título|el título del patrón|texto|el estilo de texto|una imagen|un subtítulo|notas",
    "Este|Esta;texto|párrafo|contenido|frase|imagen;es;de ejemplo|de relleno|de muestra|de prueba|provisional|temporal",
    "Texto|Párrafo|Contenido|Imagen|Título;de ejemplo|de relleno|de muestra|de prueba|provisional|por definir|pendiente",
    "Reemplace|Sustituya|Cambie|Borre|Elimine;este|esta|el;texto|párrafo|contenido|título|frase|ejemplo;por el suyo|por el definitivo|por su contenido|cuando termine|con su información",
    "Primer|Segundo|Tercer|Cuarto|Quinto;nivel;|de texto|del esquema|de la lista",
    "Type|Enter|Write|Insert|Add|Put|Paste;your;text|content|title|heading|description|message|name;here|in this box|in this space",
    "Your;text|content|title|image|logo|description|tagline;here|goes here",
    "Click|Tap|Press;here to|to;add|edit|insert|change;text|a title|Master title style|Master text styles|a subtitle|an image|notes|your text",
    "This is;a|some|only;sample|dummy|example|placeholder|filler|test;text|paragraph|content",
    "Sample|Dummy|Example|Placeholder|Filler|Test;text|paragraph|content|title|image;goes here|to be replaced|only|",
    "Replace|Delete|Change|Remove;this;text|paragraph|content|title|example;with your own|with the final text|with real content|when done",
    "First|Second|Third|Fourth|Fifth;level;|of the outline|of the list|heading",
    "Digite|Escreva|Insira|Coloque|Adicione;aqui;o texto|seu texto|seu título|seu nome|um parágrafo|uma descrição",
    "Clique|Toque;aqui para|para;adicionar|editar|inserir|alterar;um título|o título mestre|texto|uma imagem|notas",
    "Este;texto|parágrafo|conteúdo;é;de exemplo|um exemplo|de preenchimento|de teste|provisório",
    "Texto|Parágrafo|Conteúdo;de exemplo|de preenchimento|de teste|provisório",
    "Substitua|Troque|Apague;este|o;texto|parágrafo|conteúdo|título;pelo seu|pelo definitivo|pelo seu conteúdo",
    "Primeiro|Segundo|Terceiro|Quarto;nível;|de texto|da lista",
)
NOTICES = (
    "La página|La dirección|El recurso|El documento|El archivo|El contenido|El enlace;no fue encontrado|no se encontró|no existe|ya no existe|no está disponible|fue movido|que busca no existe|está dañado|no se puede abrir|no se puede mostrar|no se pudo cargar",
    "Página|Recurso|Archivo|Documento|Servicio;no encontrada|no encontrado|no disponible|prohibido|restringido",
    "Acceso;denegado|prohibido|no autorizado|restringido",
    "El servicio|El servidor|El sitio|El portal|La aplicación;no está disponible|no responde|está en mantenimiento|está sobrecargado|ha fallado|tardó demasiado en responder;en este momento|por ahora|temporalmente|",
    "Error|HTTP|Código;400|401|403|404|408|410|429|500|502|503|504;error interno del servidor|solicitud incorrecta|tiempo de espera agotado|puerta de enlace no válida|respuesta no válida del servidor|prohibido|no encontrado",
    "Se agotó|Se excedió|Ha vencido;el tiempo de espera|el tiempo límite;de la conexión|de la solicitud|del servidor",
    "No se pudo|No fue posible|No podemos|No pudimos;establecer|abrir|iniciar|completar|cargar|mostrar|procesar;la conexión|la página|la solicitud|el archivo|la operación|una conexión con la base de datos",
    "Su|La;sesión|clave|autorización;ha expirado|ha caducado|ha vencido|expiró|no es válida;inicie sesión otra vez|vuelva a entrar|",
    "No tiene|Usted no tiene;permiso|permisos|autorización;para ver|para abrir|para entrar en;esta página|este recurso|este sitio",
    "Demasiadas|Muchas;solicitudes|peticiones;espere un momento|intente después|vuelva a intentarlo",
    "Intente|Intentar|Pruebe|Vuelva a intentar|Inténtelo;de nuevo|otra vez|más tarde|en unos minutos|a recargar la página|recargando",
    "Verifique|Compruebe|Revise;la dirección|la URL|el enlace|su conexión|los permisos;e intente otra vez|y vuelva|y regrese|;a la página principal|al portal|",
    "Volver|Vuelva|Regresar|Regrese|Ir;al inicio|a la página principal|a la portada|atrás|a la página que visitaba",
    "Si el problema|Si el error|Si la falla;persiste|se repite|sigue;contacte|informe|avise|escriba;al administrador|al soporte técnico|a soporte",
    "Código|Número|Identificador;de error|de referencia|de seguimiento|de incidente|de solicitud;: 3f9a1c07e4|: 90bd52f81a|: 7c4e0a66d2|: a1b2c3d4e5",
    "Active|Habilite|Encienda|Permita;JavaScript|los scripts|la ejecución de scripts|las secuencias de comandos;en su navegador|en el navegador|en la configuración|;para ver|para continuar|para usar;el contenido|esta página|la página|este sitio",
    "Esta aplicación|Este sitio|Este portal|Este mapa|Esta página|Esta web;requiere|necesita|no funciona sin|usa|depende de;JavaScript|scripts|scripts activados|JavaScript activado;para funcionar|para mostrarse|",
    "Su navegador|El navegador;bloquea|no admite|tiene desactivados|ha bloqueado;los scripts|JavaScript|las secuencias de comandos",
    "Cargando|Espere|Un momento;...|…;active JavaScript|debe habilitar los scripts|los scripts están desactivados",
    "The page|The resource|The document|The file|The content|The link;was not found|cannot be found|does not exist|is not available|was moved|you are looking for does not exist|is damaged|cannot be opened|could not be loaded",
    "Page|Resource|File|Document;not found|not available|unavailable|missing",
    "Access|Permission;denied|forbidden|not allowed|restricted",
    "The service|The server|The site|The application|The gateway;is unavailable|is not responding|is down for maintenance|is overloaded|did not respond|returned an invalid response;at this time|right now|temporarily|",
    "Error|HTTP|Code;400|401|403|404|408|410|429|500|502|503|504;internal server error|bad gateway|gateway timeout|invalid response|forbidden|not found|bad request",
    "The connection|The request|Your request|The operation;timed out|has expired|failed|was refused|could not be completed",
    "Could not|We could not|We couldn't|Unable to|Cannot;connect to|reach|open|load|display|establish a connection to;the database|the server|the page|this page|the document|the file",
    "Your|The;session|login|token;has expired|is no longer valid|expired|timed out;log in again|please sign in|",
    "You don't have|You do not have;permission|access|rights;to view|to open|to access;this page|this resource|this site",
    "Too many;requests|attempts;please wait|slow down|try later",
    "Try|Please try;again|again later|reloading the page|once more|in a few minutes",
    "Check|Verify;the address|the URL|the link|your connection;and try again|and return|;to the home page|to the main page|",
    "Go|Return;back|home|to the home page|to the main page|to where you came from",
    "If the problem|If the error|If this;persists|continues|happens again;contact|inform|write to;the administrator|the site administrator|support|technical support",
    "Error|Reference|Request|Incident|Tracking;code|number|id;: 3f9a1c07e4|: 90bd52f81a|: 7c4e0a66d2|: a1b2c3d4e5",
    "Please enable|Enable|Turn on|Allow|Switch on;JavaScript|scripts|scripting|script execution;in your browser|in the settings|;to view|to continue|to use|to run;this page|the page|this site|this app",
    "This app|This site|This page|This application|The map;requires|needs|does not work without|doesn't work without|uses;JavaScript|scripts|scripting|JavaScript enabled;to work|to run|to work properly|",
    "Your browser|The browser;blocks|does not support|has disabled;scripts|JavaScript|scripting",
    "Loading|Please wait|One moment;...|…;JavaScript is required|please enable scripts|you need to enable JavaScript",
    "A página|O recurso|O documento|O arquivo|O conteúdo;não foi encontrado|não foi encontrada|não existe|não está disponível|está danificado|não pode ser aberto|não pôde ser carregado",
    "Página|Recurso|Serviço|Arquivo;não encontrada|não encontrado|indisponível|proibido",
    "Acesso;negado|proibido|não autorizado",
    "O serviço|O servidor|O site|O portal;está indisponível|não responde|está em manutenção|falhou;no momento|por enquanto|temporariamente|",
    "Erro|HTTP;400|403|404|429|500|502|503|504;erro interno do servidor|tempo esgotado|requisição inválida|proibido|não encontrado|o servidor não respondeu",
    "Não foi possível|Não conseguimos;carregar|abrir|mostrar|conectar;a página|o arquivo|ao servidor|ao banco de dados",
    "Sua|A;sessão|conexão|senha;expirou|caducou|foi encerrada|falhou;faça login novamente|",
    "Muitas|Demasiadas;solicitações|requisições;aguarde um momento|tente depois",
    "Tente|Tentar;novamente|de novo|mais tarde|recarregar a página",
    "Verifique|Confira;o endereço|o link|a conexão;e tente de novo|e volte|;à página inicial|",
    "Voltar|Volte|Ir;ao início|à página inicial|à página principal",
    "Se o problema|Se o erro;continuar|persistir;avise|contate|informe;o administrador|o suporte",
    "Código|Número;de erro|de referência|de incidente;: 3f9a1c07e4|: 90bd52f81a|: 7c4e0a66d2",
    "Ative|Habilite|Ligue|Permita;o JavaScript|JavaScript|os scripts|a execução de scripts;no navegador|nas configurações|;para ver|para continuar;o conteúdo|esta página|a página",
    "Este aplicativo|Este site|Esta página|Este mapa;requer|precisa de|não funciona sem|usa;JavaScript|scripts|scripts ativados|JavaScript ativado;para funcionar|",
    "Seu navegador|O navegador;bloqueia|não aceita|está bloqueando;os scripts|JavaScript",
    "Carregando|Aguarde;...|…;é preciso ativar o JavaScript|ative os scripts",
    "java|javax|org.apache|com.example;.lang|.util|.io|.net;.NullPointerException|.RuntimeException|.IOException|.TimeoutException",
    "  at;com.example|app|main|server|java.base;.Main|.Handler|.Server|.Page|.Thread;.run|.open|.load|.call|.start;(Main.java:12)|(Handler:48)|(Server.java:203)|(Unknown Source)",
    "Traceback (most recent call last)|Unhandled exception|Uncaught exception|Excepción no controlada|Exception in thread main|Exceção não tratada|Fatal error;: line 12|: at line 240|: null pointer|: out of memory|",
)
NAVIGATION = (
    "Inicio Nosotros Servicios Noticias Contacto Buscar Ayuda".split(),
    "Home About Services News Contact Search Help".split(),
    "Início Sobre Serviços Notícias Contato Busca Ajuda".split(),
)


def combinations(grammar: str) -> Iterator[str]:
    """Sentences of a grammar; what begins with a sign joins the word before it."""
    for parts in itertools.product(*(slot.split("|") for slot in grammar.split(";"))):
        out = ""
        for p in parts:
            out += p if not out or p[:1] in ":.(…" or not p else " " + p
        yield out.replace("( ", "(")


def made_up_latin(n: int = 6000) -> Iterator[str]:
    """Words of one or two syllables of the Latin passages and an ending, by a fixed rule."""
    syllables = sorted({m for w in " ".join(LATIN).lower().split() for m in re.findall(r"[^aeiou\W]{1,2}[aeiou]+[^aeiou\W]?", w)})
    k = len(syllables)
    for i in range(n):
        first, second = syllables[i * 7 % k], syllables[(i * 31 + i // k) % k].rstrip("aeiou")
        yield (first + second if i % 2 else first.rstrip("aeiou")) + ENDINGS[i * 5 % len(ENDINGS)]


def keyboard_runs() -> Iterator[str]:
    """Neighbouring keys, and one key pressed again and again."""
    for row in KEYBOARD[:3]:
        for size in (3, 4, 5):
            yield from (row[i : i + size] for i in range(len(row) - size + 1))
        yield from (c * n for c in row for n in (3, 4))


def latin_text() -> str:
    words = [w.capitalize() if i % 9 == 0 else w + "." if i % 9 == 8 else w for i, w in enumerate(made_up_latin())]
    return "\n".join([*LATIN * 3, " ".join(words)])


def filler_text() -> str:
    runs = list(keyboard_runs())
    keys = " ".join(f"{a} {a} {runs[(i + step) % len(runs)]} {LONE_WORDS[i % len(LONE_WORDS)]}" for step in (1, 7, 12, 31) for i, a in enumerate(runs))
    lone = " ".join(f"{w} {w} {w} {v}" for w, v in itertools.product(LONE_WORDS, LONE_WORDS))
    return "\n".join([keys, lone, ". ".join(s for g in FILLER for s in combinations(g))])


def notice_text() -> str:
    statuses = ". ".join(f"{s.value} {s.phrase}. {s.value} - {s.phrase}. HTTP {s.value}: {s.phrase}. Error {s.value}: {s.description or s.phrase}" for s in HTTPStatus if s >= 400)
    bars = ". ".join(" | ".join(x) for words in NAVIGATION for x in itertools.permutations(words, 3))
    sentences = ". ".join(s for g in NOTICES for s in combinations(g))
    return "\n".join([*[statuses] * 5, bars, sentences])


#: Names of fields, and forms in which tools of documents write a field; {} is the name.
FIELD_NAMES = "nombre|nombre completo|municipio|departamento|entidad|fecha|fecha de inicio|valor|valor total|número|dirección|responsable|cargo|título|barrio|name|full name|date|title|owner|address|amount|total value|number|city|company|nome|data|endereço|município|bairro|responsável|número do documento".split("|")
FIELD_FORMS = ("{{{{{}}}}}", "{{{{ {} }}}}", "${{{}}}", "${{ {} }}", "[[{}]]", "[[ {} ]]", "%%{}%%", "@@{}@@", "{{% {} %}}", "%{{{}}}", "#{{{}}}", "<%= {} %>")
#: Forms that hold names in capitals.
CAPITAL_FORMS = ("$${}$$", "__{}__", "#{}#", "<<{}>>", "{{{}}}", "[{}]", "<{}>")
#: Words that ask for a field to be filled, put before a name within any brackets.
TO_FILL = "insertar|insertar aquí|inserte|por completar|completar|a completar|por definir|por diligenciar|diligenciar|escribir|indicar|ingresar|insert|insert here|to be completed|to complete|to be filled|fill in|enter|type|inserir|a preencher|preencher|a definir|indicar o".split("|")
BRACKETS = ("<{}>", "«{}»", "[{}]", "({})", "“{}”", "{{{}}}")
#: Dates and numbers whose digits were not filled in.
BLANKS = ("XX de XXXX de 20XX", "XX/XX/20XX", "XX/XX/XXXX", "XX-XX-XXXX", "XX XXXX 20XX", "XXXX XX, 20XX", "XX.XX.20XX", "XX de XXXXX de XXXX", "20XX/XX/XX")
#: What stands in brackets or between signs and is no field: tokens of models, markup, references, asides, code.
NO_FIELDS = (
    "<|endoftext|> <|im_start|> <|im_end|> <|user|> <|assistant|> <|system|> <s> </s> <pad> <unk> <mask> <eos> <bos> [INST] [/INST] [CLS] [SEP] [MASK] [PAD] [UNK] [BOS] [EOS] <<SYS>> <</SYS>> <|fim_prefix|>"
    " <p> </p> <br> <br/> <div> </div> <b> </b> <i> <em> <strong> <span> <table> <td> <tr> <li> <ul> <h1> <a> <img> <html> <body> <script> <style>"
    " [1] [12] [3,4] [sic] [...] […] (1) (a) (ii) (2019) (DANE) (POT) (IGAC) (SIG) [nota] [aprox] (km) (ha) (%)"
).split() + [
    "(por ejemplo)", "(véase el anexo)", "(ver mapa)", "(for example)", "(see annex)", "(código 12)", "(veja o anexo)", "[traducción nuestra]", "«sí»", "“buen vivir”", "<a href=x>", "<div class=y>", "[texto](enlace)",
    "$x$", "$$x+y$$", "{a, b}", "{1}", "{}", "[]", "()", "__init__", "____", "##", "# Título", "siglo XX", "siglo XXI", "Luis XIV", "XXI", "XXX", "&nbsp;", "&amp;", "&#243;", "@alcaldia", "#agua", "100%", "%d", "$1.000",
]


#: Names that are code and no name of a field.
CODE_NAMES = ("capa:base", "a:b", "obj.attr", "lista|orden", "x=1", "f(x)", "if x", "end", "a, b", "1", "x + y", "user.name", "k: v", "")
#: Words in brackets that quote or explain.
ASIDES = "nota|aprox|traducción nuestra|énfasis añadido|por ejemplo|véase el anexo|ver mapa|según el plan|en millones|antes municipio|for example|see annex|emphasis added|veja o anexo|grifo nosso|Plan de Acción|Ley de Tierras|buen vivir|agua para todos|Water for Life".split("|")
ACRONYMS = "DANE POT IGAC SIG PIB ONG UN ONU EU USA IBGE SUS GIS".split()


def field_groups() -> Iterator[Iterator[str]]:
    """Fields for training, a group for each form."""
    names = [*FIELD_NAMES, *(n.replace(" ", "_") for n in FIELD_NAMES)]
    for f in FIELD_FORMS:
        yield (f.format(n) for n in (*names, *(n.upper() for n in names)))
    for f in CAPITAL_FORMS:
        yield (f.format(n.upper()) for n in names)
    for bracket in BRACKETS:
        yield (bracket.format(ask) for ask in (*TO_FILL, *(a.capitalize() for a in TO_FILL)))
        yield (bracket.format(ask + sep + n) for ask in TO_FILL for sep in (" ", ": ") for n in FIELD_NAMES[::3])
    yield from ((b,) for b in BLANKS)


def other_groups() -> Iterator[Iterator[str]]:
    """What is no field, for training, a group for each kind."""
    yield from ((x,) for x in NO_FIELDS)
    for f in (*FIELD_FORMS, *CAPITAL_FORMS):
        yield (f.format(n) for n in CODE_NAMES)
        # A form with a sign missing at its end or its beginning.
        yield (f.format(n)[cut] for n in FIELD_NAMES for cut in (slice(0, -1), slice(1, None)) if len(f.format("")) > 2)
    for bracket in ("({})", "[{}]", "«{}»", "“{}”", "{{{}}}"):
        yield (bracket.format(x) for x in (*ASIDES, *(w for words in NAVIGATION for w in words)))
        yield (bracket.format(x) for x in ACRONYMS)
        yield (bracket.format(x) for x in ("1", "12", "2019", "3, 4", "a", "ii", "12 %", "3,5 km", "p. 4", "https://example.org", ""))


def fields() -> Iterator[str]:
    """All fields of the groups."""
    return itertools.chain.from_iterable(field_groups())
