"""The plumbing of structure functions, with a stand-in for the optional package."""

import pandas as pd
import pytest

from grafloom.functions import chem


class Mol:
    def __init__(self, smiles):
        self.smiles = smiles


class Chem:
    @staticmethod
    def MolFromSmiles(s):
        return None if s == "bad" else Mol(s)

    @staticmethod
    def MolToSmiles(m):
        return m.smiles.upper()

    @staticmethod
    def MolToInchiKey(m):
        return "" if m.smiles == "c" else "KEY-" + m.smiles

    @staticmethod
    def GetMolFrags(m, asMols):
        parts = [Mol(x) for x in m.smiles.split(".")]
        for p in parts:
            p.GetNumHeavyAtoms = lambda p=p: len(p.smiles)
        return parts


class Keys:
    @staticmethod
    def GenMACCSKeys(m):
        return type("B", (), {"ToBitString": lambda self: "0" + "1" * 166})()


class Mass:
    @staticmethod
    def CalcMolFormula(m):
        return "F" + m.smiles


@pytest.fixture(autouse=True)
def stand_in(monkeypatch):
    monkeypatch.setattr(chem, "_rdkit", lambda: (Chem, None, Keys, Mass))


def run(function, *smiles):
    return function.func(pd.Series(list(smiles), dtype=object)).tolist()


def test_nulls_and_unreadable_structures_are_null():
    assert run(chem.canonical_smiles(), "c.ccc", "bad", None, "") == ["C.CCC", None, None, None]
    assert run(chem.canonical_smiles(largest_fragment=True), "c.ccc") == ["CCC"]
    assert run(chem.inchikey(), "cc", "c", "bad") == ["KEY-cc", None, None]
    assert run(chem.molecular_formula(), "cc", "bad") == ["Fcc", None]


def test_keys_with_and_without_the_unused_first():
    assert [len(run(chem.maccs(n), "c")[0]) for n in (167, 166)] == [167, 166]
    assert run(chem.maccs(166), "c")[0][0] == "1" and run(chem.maccs(), "c")[0][0] == "0"


def test_without_the_package_a_call_says_so(monkeypatch):
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="rdkit"):
        run(chem.inchikey(), "cc")
