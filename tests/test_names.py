import pytest

from grantlens.functions import names as nm


@pytest.mark.parametrize(
    "name, bare",
    [
        ("Acme Ltd", "Acme"),
        ("Ltd", ""),
        ("Acme S.A.", "Acme"),
        ("Foo GmbH & Co. KG", "Foo"),
        ("Bar Co., Ltd.", "Bar"),
        ("50%", "50%"),
        ("Pty Holdings", "Pty Holdings"),
        ("Incas", "Incas"),
        (None, None),
    ],
)
def test_company_forms_are_stripped_from_the_end(one, name, bare):
    assert one(nm.strip_suffix, name) == bare


def test_clean_name(one):
    def clean(name):
        return nm.clean_name(name, [("Intl", "international"), ("co", "company")], ["ltd", "the"])

    assert one(clean, " Acme-Intl Co. LTD ") == "AcmeIntl company"
    assert one(clean, "Intl. R&D (the) Labs") == "international R&D the labs"
    assert one(clean, "Scope THE") == "Scope"
    assert one(clean, None) is None
