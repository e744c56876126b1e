"""The classifiers' word lists and tables as data, and the expressions they compile to.

All values below are fixed: they decide which label an act gets. A list is one string of words set apart by commas; the first list, in
order, that a text holds a word of gives the label.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Declared subject -> axis.
AXIS_OF_LABEL = {
    "Derechos Municipales y Tarifas": "derechos_tarifas",
    "Derechos Municipales y cobro de tarifas": "derechos_tarifas",
    "Derechos, Tarifas y Concesiones Municipales": "derechos_tarifas",
    "Comercio, Alcoholes y Patentes": "comercio_publicidad",
    "Comercio, Vía Pública y Patentes": "comercio_publicidad",
    "Patentes, Comercio y Alcoholes": "comercio_publicidad",
    "Comercio, Rentas y Patentes": "comercio_publicidad",
    "Comercio, Alcoholes y Ferias": "comercio_publicidad",
    "Alcoholes y Seguridad Ciudadana": "comercio_publicidad",
    "Comercio, Vía Pública y Publicidad": "comercio_publicidad",
    "Aseo, Ornato y Gestión de Residuos": "aseo_residuos",
    "Aseo, Ornato y Medio Ambiente": "aseo_residuos",
    "Medio Ambiente y Aseo": "aseo_residuos",
    "Medio Ambiente y Sustentabilidad": "medio_ambiente",
    "Medio ambiente, protección de humedales urbanos y biodiversidad": "medio_ambiente",
    "Tenencia Responsable de Mascotas": "medio_ambiente",
    "Tenencia Responsable y Mascotas": "medio_ambiente",
    "Tenencia responsable de mascotas y bienestar animal": "medio_ambiente",
    "Medio Ambiente, Humedales y Tenencia Responsable": "medio_ambiente",
    "Tránsito y Transporte": "transito_transporte",
    "Tránsito, Transporte y Estacionamientos": "transito_transporte",
    "Tránsito, Transporte y Espacio Público": "transito_transporte",
    "Urbanismo, Obras y Edificación": "obras_espacio_publico",
    "Urbanismo, Obras y Construcción": "obras_espacio_publico",
    "Obras, Urbanismo y Espacio Público": "obras_espacio_publico",
    "Plan Regulador y Obras": "obras_espacio_publico",
    "Urbanismo, Obras y Plan Regulador": "obras_espacio_publico",
    "Convivencia Vecinal y Ruidos Molestos": "convivencia_ruidos",
    "Convivencia Vecinal y Seguridad": "convivencia_ruidos",
    "Normas Sanitarias y Convivencia": "convivencia_ruidos",
    "Seguridad y Convivencia": "seguridad_prevencion",
    "Seguridad Ciudadana y Convivencia": "seguridad_prevencion",
    "Seguridad Ciudadana y Prevención": "seguridad_prevencion",
    "Organización y Régimen Interno": "organizacion_participacion",
    "Organización Interna y Personal": "organizacion_participacion",
    "Subvenciones y Régimen Interno": "organizacion_participacion",
    "Subvenciones, aportes y fomento comunitario": "organizacion_participacion",
    "Participación Ciudadana": "organizacion_participacion",
    "Participación y Organizaciones Comunitarias": "organizacion_participacion",
    "Participación Ciudadana y Gobernanza Local": "organizacion_participacion",
    "Salud, Deporte y Desarrollo Social": "organizacion_participacion",
    "Salud, Higiene y Bienestar Social": "organizacion_participacion",
    "Educación, Becas y Desarrollo Social": "organizacion_participacion",
    "Desarrollo Social y Grupos Prioritarios": "organizacion_participacion",
    "Organización Interna y Participación Ciudadana": "organizacion_participacion",
}

#: The nine axes by the words of a title. An accent may be written or not, a blank is any white space.
AXES = [
    ("convivencia_ruidos", "ruido, acústic, sonor"),
    ("derechos_tarifas", "derecho, tarifa, arancel, concesión, cobro, rentas"),
    ("comercio_publicidad", "comercio, patente, alcohol, feria, propaganda, publicidad, kiosco, ambulante, mercado"),
    ("aseo_residuos", "aseo, basura, residuo, limpieza, escombro, recolección"),
    ("medio_ambiente", "humedal, biodiversidad, medio ambiente, mascota, animal, canin, perro, arbolado"),
    ("transito_transporte", "tránsito, transporte, vehícul, estacionamiento, paradero, circulación"),
    ("obras_espacio_publico", "obra, urbanis, edific, construc, plan regulador, cierro, antena, fachada, paviment"),
    ("seguridad_prevencion", "seguridad, alarma, vigilancia, prevención, delito"),
]
DEFAULT_AXIS = "organizacion_participacion"
#: Fixed value: the list that the later version of the axes adds, with the default's own label.
LAST_AXIS = (DEFAULT_AXIS, "participación, plebiscito, cosoc, comunitari, subvención, junta, concejo, personal, estatuto")

#: General subjects, by words as they are written.
GENERAL = [
    ("derechos_tarifas", "derecho, tarifa, arancel, permiso, cobro, exencion"),
    ("aseo_medioambiente", "aseo, basura, residuo, medio ambiente, ambiental, reciclaje, escombro, arbolado, humedal, apicola, medioambiente"),
    ("alcoholes_comercio", "alcohol, patente, comercio, comercial, feria, propaganda, publicidad, kiosco, productores"),
    ("transito_transporte", "transito, vehiculo, estacionamiento, parquimetro, transporte, vial, conductor"),
    ("urbanismo_obras", "urbanismo, obra, edificacion, construccion, plan regulador, tendido, cable, antena"),
    ("seguridad_convivencia", "seguridad, ruido, convivencia, vecinal, alarma, camara, orden publico"),
    ("tenencia_mascotas", "mascota, perro, gato, animal, tenencia responsable, canino, zoonosis"),
]

#: Subjects of acts kept in folders, and the subject of a folder where no word decides.
FOLDERS = [
    ("tenencia_mascotas", "mascota, animal, canino, cholito, perro, gato"),
    ("derechos_tarifas", "derecho, tarifa, arancel, cobro de derecho"),
    ("aseo_medioambiente", "aseo, basura, residuo, reciclaje, limpieza"),
    ("aseo_medioambiente", "medio ambiente, árbol, hídric, plástico, humedal"),
    ("convivencia_seguridad", "ruido, molesto, convivencia, seguridad, cierre pasaje"),
    ("comercio_alcoholes", "alcohol, patente, comercio, kiosco, publicidad"),
    ("transito_transporte", "tránsito, transito, estacionamiento, parquímetro, vehículo"),
    ("urbanismo_obras", "obra, urbanismo, construcción, edificación, antejardín"),
    ("participacion_ciudadana", "participación, cosoc, organización comunitaria, plebiscito"),
    ("organizacion_interna", "subvención, subvenciones, fondo concursable, fondeve"),
]
FOLDER_SUBJECT = {
    "aseo_medioambiente": "aseo_medioambiente",
    "urbanismo_obras": "urbanismo_obras",
    "comercio_alcoholes": "comercio_alcoholes",
    "derechos_tarifas": "derechos_tarifas",
    "transito_transporte": "transito_transporte",
    "sanitarias": "convivencia_seguridad",
    "normativa_general": "normativa_general",
}

#: Topics of three portals; what no list holds is on fees.
TOPICS_A = [
    ("derechos_tarifas", "derecho, tarifa, arancel, cobro, renta, concesion"),
    ("aseo_residuos", "aseo, basura, residuo, escombro, limpieza"),
    ("comercio_publicidad", "artesania, comercio, via publica, ambulante, feria, kiosko, propaganda, publicidad"),
    ("convivencia_ruidos", "ruido, convivencia, vecinal, molesto, alcohol"),
    ("medio_ambiente", "arbolado, area verde, humedal, mascota, animal, tenencia responsable"),
    ("obras_espacio_publico", "cierre de calle, tendido, cable, subterraneo, aereo, obra, edificacion, regulador, espacio publico, construccion"),
    ("transito_transporte", "transito, estacionamiento, vehiculo, transporte, carga"),
    ("organizacion_participacion", "participacion, plebiscito, consulta, junta de vecino, organizacion"),
    ("seguridad_prevencion", "seguridad, vigilancia, delito, prevencion"),
]
TOPICS_B = [
    ("derechos_tarifas", "derecho, tarifa, arancel, cobro, renta, concesion"),
    ("aseo_residuos", "aseo, basura, residuo, escombro, limpieza"),
    ("comercio_publicidad", "comercio, via publica, ambulante, feria, kiosko, propaganda, publicidad, alcohol"),
    ("convivencia_ruidos", "ruido, convivencia, vecinal, molesto"),
    ("medio_ambiente", "arbolado, area verde, humedal, mascota, animal, tenencia responsable"),
    ("obras_espacio_publico", "cierre de calle, tendido, cable, obra, edificacion, regulador, espacio publico, construccion, urban"),
    ("transito_transporte", "transito, estacionamiento, vehiculo, transporte, carga"),
    ("organizacion_participacion", "participacion, plebiscito, consulta, junta de vecino, organizacion"),
    ("seguridad_prevencion", "seguridad, vigilancia, delito, prevencion"),
]
TOPICS_C = [
    ("derechos_tarifas", "derecho, tarifa, arancel, cobro, renta, concesion"),
    ("aseo_residuos", "aseo, basura, residuo, escombro, limpieza"),
    ("comercio_publicidad", "mesas, comercio, via publica, ambulante, feria, kiosko, propaganda, publicidad"),
    ("convivencia_ruidos", "ruido, convivencia, vecinal, molesto, mascarilla, distanciamiento"),
    ("medio_ambiente", "humedal, mascota, animal, tenencia responsable"),
    ("obras_espacio_publico", "cierre de calle, tendido, cable, obra, edificacion, regulador, espacio publico, construccion"),
    ("organizacion_participacion", "participacion, plebiscito, consulta, junta de vecino, organizacion"),
]

#: The refinement of one list, and the words of records that it leaves out.
REFINED = [
    ("comercio_publicidad", "artesanía, comercio"),
    ("obras_espacio_publico", "cierre, tendidos, plan regulador, vías públicas"),
    ("aseo_residuos", "aseo, residuos"),
    ("organizacion_participacion", "transparencia, delegacion, reglamento n°937"),
    ("derechos_tarifas", "derecho, tarifa, ordenanza n°94"),
]
NOT_REFINED = "formulario, cierre de año contable, revisión jurídica de contratos, beca"

#: The basket's five topics, each with the words of a title or declared subject (whole words, without accents; `s?` a
#: letter that may lack, `|` alternatives in brackets, a blank any white space or none) and the declared ids that stand for it.
BASKET = [
    (
        "derechos",
        "derecho, derechos, tarifa, tarifas, arancel, aranceles, rentas? municipales, concesiones,? permisos y servicios, cobro de derechos, derechos municipales, derecho de aseo, exencion de derechos, pagos? de derechos",
        "derechos_tarifas, derechos_municipales",
    ),
    (
        "aseo_ambiente",
        "aseo, ornato, residuos?, basuras?, medio ambiente, ambiental, vertederos?, escombros?, reciclaje, recoleccion, desechos?, limpieza, microbasurales?, areas? verdes?, arbolado, humedales?, bolsas? plasticas?, sustentabilidad, sustentable, cambio climatico, biodiversidad",
        "aseo_medioambiente, aseo_residuos, medio_ambiente",
    ),
    (
        "seguridad_ruidos",
        "ruidos?, sonidos? molestos?, contaminacion acustica, acustica, fuentes sonoras, seguridad, convivencia, tranquilidad, orden publico, incivilidades?, acoso callejero, cierre de calles?, cierre de pasajes?, camaras, televigilancia, rayados?, graffitis?, vigilancia, guardias, seguridad ciudadana, seguridad publica, alcohol en la via publica",
        "seguridad_convivencia, convivencia_seguridad, convivencia_ruidos",
    ),
    (
        "mascotas",
        "mascotas?, animales? de compania, tenencia responsable, canino, canina, perros?, felinos?, gatos?, zoosanitari[ao], bienestar animal, proteccion animal, veterinari[ao], ley cholito, control canino, mordeduras?, fauna urbana, palomas, plagas",
        "mascotas_animales, tenencia_mascotas, mascotas, tenencia_responsable_mascotas",
    ),
    (
        "participacion",
        "participacion ciudadana, participacion (?:de la )?comunidad, participacion vecinal, cosoc, consejo comunal de la sociedad civil, consejo economico y social, cesco, plebiscitos?, consultas? ciudadanas?, audiencias? publicas?, cabildos? (?:comunales?|ciudadanos?), presupuestos? participativos?, organizaciones comunitarias",
        "participacion_ciudadana",
    ),
]
#: Titles for which the declared id of a topic does not count.
BASKET_GUARD = {"seguridad_ruidos": "denominacion de poblaciones, cambio de nombre"}

#: What an act does to another, by words of title and description.
NATURES = [
    ("texto_refundido", "texto refundido, refundido y sistematizado, texto refundido y coordinado"),
    ("modificacion", "modifica, modificación, sustituye, deroga el artículo, reemplázase"),
    ("extracto_do", "extracto, publicación diario oficial, publicacion diario oficial"),
]

_BOTH = dict(zip("áéíóú", ("[aá]", "[eé]", "[ií]", "[oó]", "[uú]"), strict=True))


def listed(words: str) -> list[str]:
    """The words of a list; a comma inside a word has a sign behind it, not a blank."""
    return re.split(r", ", words)


def pattern(words: str, either_accent: bool = False) -> str:
    """A pattern, for Java and RE2 alike, that any word of a list matches anywhere."""
    one = lambda w: "".join(_BOTH.get(x, x) for x in w).replace(" ", r"\s+") if either_accent else re.escape(w).replace(r"\ ", " ")
    return "|".join(map(one, listed(words)))


def whole_words(words: str) -> str:
    """A pattern that any word of a basket list matches as a whole."""
    return r"\b(?:" + "|".join(w.replace(" ", r"\s*") for w in re.split(r", (?![?])", words)) + r")\b"


def first_list(c: Column, lists: list[tuple[str, str]], default: Column | str, either_accent: bool = False) -> Column:
    """The label of the first list that the text holds a word of, else the default; null text gets the default."""
    out = default if isinstance(default, Column) else F.lit(default)
    for label, words in reversed(lists):
        out = F.when(F.coalesce(c.rlike(pattern(words, either_accent)), F.lit(False)), label).otherwise(out)
    return out


def first_list_sql(text: str, lists: list[tuple[str, str]], default: str, either_accent: bool = False) -> str:
    """The same in SQL. With words as they are written: contains, word by word."""
    quote = lambda w: w.replace("'", "''")
    hit = lambda words: f"regexp_matches({text}, '{quote(pattern(words, True))}')" if either_accent else "(" + " or ".join(f"contains({text}, '{quote(w)}')" for w in listed(words)) + ")"
    return "case " + " ".join(f"when {hit(words)} then '{label}'" for label, words in lists) + f" else {default} end"


def basket(title: Column, label: Column, declared: Column) -> Column:
    """The topics of the basket that an act belongs to, sorted: by its title, by its declared id unless the title guards against it, by
    its declared subject. title and label: without accents, in ASCII, lower case."""
    hits = []
    for topic, words, ids in BASKET:
        by_title, by_label = F.coalesce(title.rlike(whole_words(words)), F.lit(False)), F.coalesce(label.rlike(whole_words(words)), F.lit(False))
        by_id = F.coalesce(declared.isin(listed(ids)), F.lit(False))
        guarded = F.coalesce(title.rlike(pattern(BASKET_GUARD[topic])), F.lit(False)) if topic in BASKET_GUARD else F.lit(False)
        # an id that is guarded against is not asked for its subject's words either
        hits.append(F.when(by_title | F.when(by_id, ~guarded).otherwise(by_label), topic))
    return F.array_sort(F.array_compact(F.array(*hits)))


def basket_sql(title: str, label: str, declared: str, topic: str) -> str:
    """Whether the act is of the topic, in SQL."""
    words, ids = next((w, i) for n, w, i in BASKET if n == topic)
    by_id = f"coalesce({declared} in ({', '.join(repr(x) for x in listed(ids))}), false)"
    guard = " or ".join(f"contains({title}, '{w}')" for w in listed(BASKET_GUARD[topic])) if topic in BASKET_GUARD else "false"
    return f"(case when coalesce(regexp_matches({title}, '{whole_words(words)}'), false) then true when {by_id} then not coalesce({guard}, false) else coalesce(regexp_matches({label}, '{whole_words(words)}'), false) end)"
