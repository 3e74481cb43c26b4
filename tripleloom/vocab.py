"""Namespaces, prefixes and classes of the graph (fixed values)."""

from __future__ import annotations

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCT = "http://purl.org/dc/terms/"
SCHEMA = "http://schema.org/"
BIOSAMPLE = "http://identifiers.org/biosample/"
BIOSAMPLE_PROPERTY = "http://ddbj.nig.ac.jp/biosample/"
BIOSAMPLE_ONT = "http://ddbj.nig.ac.jp/ontologies/biosample/"
SRA = "http://identifiers.org/insdc.sra/"
DRA_ONT = "http://ddbj.nig.ac.jp/ontologies/dra/"
BIOPROJECT = "http://identifiers.org/bioproject/"
BIOPROJECT_ONT = "http://ddbj.nig.ac.jp/ontologies/bioproject/"

#: Accession types of the TSV source and their classes.
SRA_CLASSES = {"SUBMISSION": "Submission", "STUDY": "Study", "SAMPLE": "Sample", "EXPERIMENT": "Experiment", "RUN": "Run", "ANALYSIS": "Analysis"}
