from pktloom.llm import pii


def test_long_parts_of_addresses():
    assert pii.base_spans("1" * 5000 + ".1.1.1") == [] and pii.shape("1" * 5000 + ".1.1.1") is None
    long = "0" * 5000 + "7.0.255.1"
    assert pii.base_spans(long) == [(1, 0, len(long))] and pii.shape(long) == 1
    assert pii.base_spans("1.2.3.256") == []
