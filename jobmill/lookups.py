"""Small fixed tables the rules read. Every list here is a fixed value."""

from __future__ import annotations

# First word found in the lower-cased location decides the state.
STATE_WORDS = (
    ("guanajuato", "Guanajuato"),
    ("gto", "Guanajuato"),
    ("irapuato", "Guanajuato"),
    ("leon", "Guanajuato"),
    ("celaya", "Guanajuato"),
    ("queretaro", "Querétaro"),
    ("qro", "Querétaro"),
    ("jalisco", "Jalisco"),
    ("guadalajara", "Jalisco"),
)

# Words that mark a remote or hybrid posting.
REMOTE_WORDS = ("remote", "remoto", "home office")
HYBRID_WORDS = ("hybrid", "hibrido", "híbrido")

# Modality labels of the listing sites.
JOB_TYPES = {
    "Remoto": "remoto",
    "Híbrido": "hibrido",
    "Presencial": "presencial",
    "Remote": "remoto",
    "Hybrid": "hibrido",
}

# State code to region.
REGIONS = {
    "GUA": "Bajío",
    "QUE": "Querétaro",
    "DIF": "CDMX",
    "MEX": "Estado de México",
    "JAL": "Guadalajara",
    "NLE": "Monterrey",
    "AGU": "Aguascalientes",
    "SLP": "San Luis Potosí",
    "ZAC": "Zacatecas",
    "HID": "Hidalgo",
    "PUE": "Puebla",
    "MOR": "Morelos",
    "BCN": "Baja California",
    "SON": "Sonora",
    "CHH": "Chihuahua",
    "COA": "Coahuila",
    "TAM": "Tamaulipas",
    "VER": "Veracruz",
    "YUC": "Yucatán",
    "ROO": "Quintana Roo",
    "TAB": "Tabasco",
    "MIC": "Michoacán",
    "GRO": "Guerrero",
    "OAX": "Oaxaca",
    "SIN": "Sinaloa",
    "COL": "Colima",
    "CAM": "Campeche",
    "NAY": "Nayarit",
    "DUR": "Durango",
    "TLA": "Tlaxcala",
    "CHP": "Chiapas",
}
BAJIO = "Bajío"

# Cities that get a region of their own inside the Bajío.
BAJIO_CITIES = (
    "irapuato",
    "léon",
    "leon",
    "silao",
    "celaya",
    "salamanca",
    "guanajuato",
    "villagrán",
    "villagran",
    "san francisco del rincón",
    "san francisco del rincon",
    "pénjamo",
    "penjamo",
    "acámbaro",
    "acambaro",
    "valle de santiago",
    "juventino rosas",
    "dolores hidalgo",
    "san miguel de allende",
)

# Country code to name used by the search, and to site subdomain and currency.
COUNTRY_NAMES = {"MX": "mexico", "CO": "colombia", "PE": "peru", "CL": "chile", "AR": "argentina"}
COUNTRY_SITES = {
    "MX": ("mx", "MXN"),
    "CO": ("co", "COP"),
    "PE": ("pe", "PEN"),
    "CL": ("cl", "CLP"),
    "AR": ("ar", "ARS"),
}

# Spanish function words.
STOP_ES = (
    "el la los las un una unos unas "
    "a ante bajo con contra de desde durante en entre hacia hasta mediante para por según sin sobre tras versus "
    "y e ni o u pero sino aunque porque pues que si como cuando donde mientras "
    "yo tu tú él ella nosotros vosotros ellos ellas me te se nos os le les lo mi mis sus su "
    "nuestro nuestra nuestros nuestras este esta estos estas ese esa esos esas "
    "aquel aquella aquellos aquellas esto eso aquello "
    "es son era fue ser estar tiene tener hay había haber hace hacer han ha he sido estado tenido hecho va ir "
    "pueda puede deben debe requiere requerimos buscamos necesitamos "
    "no sí también tampoco solo sólo muy más menos bien mal aquí ahí allí allá ahora antes después ya aún "
    "todavía siempre nunca jamás casi bastante demasiado tan tanto así además incluyendo "
    "todo toda todos todas mucho mucha muchos muchas poco poca pocos pocas otro otra otros otras "
    "mismo misma mismos mismas cada cual cuales quien quienes "
    "uno dos tres cuatro cinco primer primera segundo segunda"
).split()

# Spanish words that nearly every posting holds.
STOP_ES_POSTING = (
    "empresa trabajo empleo puesto cargo perfil candidato candidata vacante oportunidad "
    "funciones actividades responsabilidades tareas requisitos requerimientos habilidades competencias "
    "beneficios ofrecemos sueldo salario remuneración compensación tiempo completo parcial contrato "
    "permanente temporal meses años año mes experiencia requerida favor postular aplicar enviar cv currículum "
    "lugar presencial semipresencial tipo"
).split()

# English function words.
STOP_EN = (
    "a an the in on at by for with about as into through during before after above below from to of up down "
    "out off over under and but or nor so yet both either neither not only whether because if when while "
    "although though since unless i you he she we they it me him her us them my your his its our their "
    "this that these those is are was were be been being have has had do does did will would shall should "
    "may might must can could very really also just more most much well even still already now here there "
    "always never too quite including"
).split()

# English words that nearly every posting holds.
STOP_EN_POSTING = (
    "company position role candidate opportunity job responsibilities requirements qualifications skills "
    "experience required preferred benefits salary apply send resume cv full time part contract permanent "
    "work place office years year months month please join team looking seeking"
).split()


def stop_words(language: str) -> list[str]:
    """Stop words of ``es`` or ``en``; any other language takes both lists."""
    spanish = [*STOP_ES, *STOP_ES_POSTING]
    english = [*STOP_EN, *STOP_EN_POSTING]
    if language == "es":
        return spanish
    if language == "en":
        return english
    return list(dict.fromkeys([*spanish, *english]))
