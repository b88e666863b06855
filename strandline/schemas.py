"""Column layouts of the headerless tables. Empty and missing fields are both null; taxids are longs."""

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in (_field(f) for f in text.split())])


def _field(f: str):
    name, _, kind = f.partition(":")
    return name, {"s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "d": T.DoubleType()}[kind or "s"]


M8 = _schema("qseqid sseqid pident:d length:l mismatch:l gapopen:l qstart:l qend:l sstart:l send:l evalue:d bitscore:d")
M8_NT = T.StructType(M8.fields + _schema("qlen:l slen:l").fields)
M8_RERANKED = T.StructType(M8_NT.fields + _schema("qcov:d hsp_count:l").fields)
HITS = _schema("read_id level:i taxid:l accession_id species_taxid:l genus_taxid:l family_taxid:l")
HITS_MERGED = T.StructType(HITS.fields + _schema("contig_id contig_accession_id contig_species_taxid:l contig_genus_taxid:l contig_family_taxid:l from_assembly source_count_type").fields)
READS_TO_CONTIGS = _schema("read_id contig_id read_length:l")
SAM = _schema("qname flag:i rname pos:l mapq:i cigar rnext pnext:l tlen:l seq qual")
PAF = _schema("qname qlen:l qstart:l qend:l strand tname tlen:l tstart:l tend:l nmatch:l alen:l mapq:l")
ACCESSIONS = _schema("accession taxid:l")
LINEAGE = _schema("taxid:l species:l genus:l family:l")
NODES = _schema("tax_id:l parent_tax_id:l rank")
NAMES = _schema("tax_id:l name_txt unique_name name_class")
TRUTH = _schema("taxid:l other abundance:d rank species_name")

#: Lineage of a taxon that isn't known, by rank; the unit of artificial taxids; taxids never counted.
NULL_SPECIES, NULL_GENUS, NULL_FAMILY = -100, -200, -300
ARTIFICIAL = 100_000_000
HUMAN = (9605, 9606)
RANKS = ("superkingdom", "kingdom", "phylum", "class", "order", "family", "genus", "species")
NULL_RANKS = {"species": -100, "genus": -200, "family": -300, "order": -400, "class": -500, "phylum": -600, "kingdom": -650, "superkingdom": -700}
