import pytest

from landfall.operators import codebook
from landfall.sources.labels import labels_of, read_labels

# Fixed values among invented ones: the opening words "INVALID:", "Collapsed", "No Country
# Code", "No PORT Code" and "All Other Codes", which the decoder must know.
LABELS = """some opening words ;
more of them ;

/* FIRST - a value in a comment
   8 = 'nothing' */
  value planetl
   11 =  'VELMOR High, and Low Moons (with a remark)'
    7 =  'TWIN SUNS '
   90 =  'INVALID: ROGUE'
   12 =  'Collapsed Shell (a remark)'
    3 =  'No Country Code (3)' ;

/* SECOND */
  value $dockl
   'Q1X'\t=\t'UPPER QUAY, VV             '
   'Q2X'\t=\t'KEEPER''S DOCK, WW      '
   'Q3X'\t=\t'GREY PIER, XX (BPS)'
   'Q4X'\t=\t'LONG WHARF, YY #ARPT'
   'Q5X'\t=\t'ROUND BASIN ZZ           '
   'Q6X'\t=\t'LOCK,VV     '
   'Q7X'\t=\t'FAR REEF, Outer, NN'
   'Q8X'\t=\t'MOLE, GREATER #RING'
   'Q9X'\t=\t'SLIP, FOG           '
   'R1X'\t=\t'Collapsed (Q1X) 01/02'
   'R2X'\t=\t'Collapsed into Q2X, WW'
   'R3X'\t=\t'Collapsed into R1X, VV'
   'R4X'\t=\t'Collapsed (R5X) 03/04'
   'R5X'\t=\t'Collapsed (R4X) 03/04'
   'R6X'\t=\t'Collapsed into GONE, WW'
   'R7' \t=\t'No PORT Code (R7)'
   'R8 '\t=\t'HERE; THERE'
;

value waysl
\t1 = 'Kite'
\t5 = 'Unsaid' ;
\t6 = 'after the end'

value $realml
\t'VV'='VARRO'
\t'WW'='WENDEL'
\t'XX'='XANTHE'
\t'YY'='YSOLD'
\t'ZZ'='ZEPHYR' 
\t'--'='All Other Codes' ;
end ;
"""


@pytest.fixture
def book(spark, tmp_path):
    (tmp_path / "labels.txt").write_text(LABELS)
    return read_labels(spark, str(tmp_path / "labels.txt"))


def test_blocks(book):
    counts = book.groupBy("format").count().collect()
    assert {r[0]: r[1] for r in counts} == {"planetl": 5, "$dockl": 17, "waysl": 2, "$realml": 6}


def test_a_large_file_is_refused(spark, tmp_path):
    (tmp_path / "labels.txt").write_text(LABELS)
    with pytest.raises(ValueError, match="larger"):
        read_labels(spark, str(tmp_path / "labels.txt"), max_bytes=100)


def test_countries(book):
    labels = labels_of(book, "planetl")
    assert {r["code"]: r["code_class"] for r in codebook.decode_countries(labels).collect()} == {
        11: "valid", 7: "valid", 90: "INVALID", 12: "Collapsed", 3: "No Country Code",
    }
    valid = {tuple(r) for r in codebook.valid_countries(labels).collect()}
    assert (7, "TWIN SUNS") in valid and len(valid) == 2


def test_ports(book):
    ports = codebook.decode_ports(labels_of(book, "$dockl"), labels_of(book, "$realml"))
    assert {r["code"]: (r["city"], r["state"]) for r in ports.collect()} == {
        "Q1X": ("UPPER QUAY", "VV"),
        "Q2X": ("KEEPER'S DOCK", "WW"),
        "Q3X": ("GREY PIER", "XX"),
        "Q4X": ("LONG WHARF", "YY"),
        "Q5X": ("ROUND BASIN", "ZZ"),
        "Q6X": ("LOCK", "VV"),
        "Q7X": ("FAR REEF, Outer, NN", None),
        "Q8X": ("MOLE, GREATER", None),
        "Q9X": ("SLIP, FOG", None),
        "R8": ("HERE; THERE", None),
        **{code: (None, None) for code in ("R1X", "R2X", "R3X", "R4X", "R5X", "R6X", "R7")},
    }


def test_aliases(book):
    resolved = codebook.resolve_port_aliases(labels_of(book, "$dockl")).collect()
    rows = {r["code"]: (r["target_code"], r["resolved_code"], r["resolved_label"]) for r in resolved}
    assert len(resolved) == 17
    assert rows["R1X"] == ("Q1X", "Q1X", "UPPER QUAY, VV")
    assert rows["R2X"] == ("Q2X", "Q2X", "KEEPER'S DOCK, WW")
    # Over another alias; in a circle; to a code that is not listed.
    assert rows["R3X"] == ("R1X", "Q1X", "UPPER QUAY, VV")
    assert rows["R4X"] == ("R5X", None, None) and rows["R5X"] == ("R4X", None, None)
    assert rows["R6X"] == ("GONE", None, None)
    assert rows["Q1X"] == (None, "Q1X", "UPPER QUAY, VV")


def test_chains_of_any_length_end_and_circles_do_not(spark):
    def label(target):
        return f"Collapsed ({target}) 06/15"

    rows = [("P0", "THE END, AA")] + [(f"P{i}", label(f"P{i - 1}")) for i in range(1, 301)]
    rows += [(f"C{i}", label(f"C{(i + 1) % 200}")) for i in range(200)] + [("D", label("C7")), ("E", label("P300")), ("F", label("F"))]
    labels = spark.createDataFrame(rows, "code string, label string")
    found = {r["code"]: r["resolved_code"] for r in codebook.resolve_port_aliases(labels).collect()}
    assert len(found) == len(rows)
    assert all(found[c] == ("P0" if c[0] in "PE" else None) for c in found)


def test_states(spark, book):
    df = spark.createDataFrame([("VV",), ("AA",), ("--",), (None,)], "c string")
    decoded = codebook.decode_states(df, labels_of(book, "$realml"), "c", "name").collect()
    assert {r["c"]: r["name"] for r in decoded} == {
        "VV": "VARRO", "AA": "All Other Codes", "--": "All Other Codes", None: "All Other Codes",
    }
