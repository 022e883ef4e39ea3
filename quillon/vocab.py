"""Vocabulary IRIs and constants of the scores."""

from __future__ import annotations

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
SKOSXL = "http://www.w3.org/2008/05/skos-xl#"
DCTERMS = "http://purl.org/dc/terms/"
OBO = "http://purl.obolibrary.org/obo/"
OBOINOWL = "http://www.geneontology.org/formats/oboInOwl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
XML = "http://www.w3.org/XML/1998/namespace"

TYPE = RDF + "type"
FIRST, REST, NIL = RDF + "first", RDF + "rest", RDF + "nil"
LABEL, COMMENT = RDFS + "label", RDFS + "comment"
SUBCLASS = RDFS + "subClassOf"
EQUIVALENT = OWL + "equivalentClass"
INTERSECTION = OWL + "intersectionOf"
THING, NOTHING = OWL + "Thing", OWL + "Nothing"
RESTRICTION, ON_PROPERTY = OWL + "Restriction", OWL + "onProperty"
PREF_LABEL = SKOS + "prefLabel"
XL_ALT_LABEL, XL_FORM = SKOSXL + "altLabel", SKOSXL + "literalForm"
ANNOTATION, OBJECT_PROPERTY, DATATYPE_PROPERTY = OWL + "AnnotationProperty", OWL + "ObjectProperty", OWL + "DatatypeProperty"
DEPRECATED, IMPORTS, ONTOLOGY, VERSION = OWL + "deprecated", OWL + "imports", OWL + "Ontology", OWL + "versionIRI"

# Fixed values of the scores; they must be these for right results.

CLASS_TYPES = (OWL + "Class", RDFS + "Class", SKOS + "Concept")

DESCRIBE_SIGNALS = (
    LABEL, COMMENT, PREF_LABEL, SKOS + "altLabel", SKOS + "definition", DCTERMS + "description", DCTERMS + "title",
    OBO + "IAO_0000115", OBOINOWL + "hasExactSynonym", OBOINOWL + "hasRelatedSynonym", OBOINOWL + "hasBroadSynonym",
    OBOINOWL + "hasNarrowSynonym",
)

#: In order of priority.
DEFINITION_PROPERTIES = (COMMENT, DCTERMS + "description", SKOS + "definition", OBO + "IAO_0000115", OBOINOWL + "hasDefinition")
LABEL_PROPERTIES = (PREF_LABEL, LABEL)

CONNECTION_ANNOTATIONS = (
    LABEL, COMMENT, RDFS + "seeAlso", RDFS + "isDefinedBy", DCTERMS + "title", DCTERMS + "creator", DCTERMS + "description",
    DCTERMS + "abstract", DCTERMS + "subject", DCTERMS + "identifier", PREF_LABEL, SKOS + "altLabel", SKOS + "hiddenLabel",
    SKOS + "definition", SKOS + "note", SKOS + "scopeNote", SKOS + "changeNote", SKOS + "editorialNote", SKOS + "historyNote",
    OBOINOWL + "hasExactSynonym", OBOINOWL + "hasRelatedSynonym", OBOINOWL + "hasBroadSynonym", OBOINOWL + "hasNarrowSynonym",
)

STRUCTURAL = (
    TYPE, SUBCLASS, RDFS + "subPropertyOf", RDFS + "domain", RDFS + "range", EQUIVALENT, OWL + "disjointWith", OWL + "unionOf",
    INTERSECTION, OWL + "complementOf", OWL + "oneOf", OWL + "sameAs", OWL + "differentFrom", OWL + "hasKey", ON_PROPERTY,
    OWL + "someValuesFrom", OWL + "allValuesFrom", OWL + "propertyChainAxiom", OWL + "inverseOf", OWL + "equivalentProperty",
)

FILLERS = (OWL + "someValuesFrom", OWL + "allValuesFrom")
NOT_DEFINITION_TEXT = (RDFS + "isDefinedBy", RDFS + "seeAlso", OWL + "sameAs")
DEFINITION_NAMES = ("definition", "def", "defn", "textualdefinition", "definitions")
STOP_WORDS = tuple("a an the and or of for in on with by to from is are was were be been being this that these those it its as at".split())

MIN_TOKENS = 12
DEPTH_TARGET = 5
BRANCH_TARGET = 3
MAX_DISTINCT = 5
RICHNESS_BASE = 11
LOW_SCORE = 4.0

#: Score column, name in texts, reason in suggestions; in the order that decides ties.
METRICS = (
    ("describe_score", "Describe", "the annotation properties and labels do not have a relatable description"),
    ("define_score", "Define", "the annotations lack semantic meaning"),
    ("connection_score", "Connection", "the entities have loose connections"),
    ("flat_score", "Flat", "the ontology lacks a clear hierarchical structure"),
)
