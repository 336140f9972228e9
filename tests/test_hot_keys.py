"""The heavy-key split gives the same purchases as the plain plan on the
real test tables."""

from ledgerline.plans import purchases as npur
from ledgerline.sources import tables as tb
from tests.conftest import rows

SMALL = "/root/testdata/sf0.001"


def test_heavy_key_split_matches_plain_plan(spark, monkeypatch):
    args = (tb.payments(spark, SMALL), tb.refunds(spark, SMALL), tb.product_history(spark, SMALL),
            tb.referral_events(spark, SMALL))
    plain = rows(npur.normalize_purchases(*args, run_ts="2024-06-01 00:00:00"))
    # Nearly every e-mail becomes "heavy" and is split into 10-day buckets;
    # the versions take the windowed path with 30-day buckets.
    monkeypatch.setattr(npur, "HOT_KEY_ROWS", 3)
    monkeypatch.setattr(npur, "EVENT_BUCKET_SECONDS", 10 * 86400)
    monkeypatch.setattr(npur, "VERSION_BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(npur, "VERSION_BUCKET_SECONDS", 30 * 86400)
    split = rows(npur.normalize_purchases(*args, run_ts="2024-06-01 00:00:00"))
    assert split == plain and len(plain) > 0
