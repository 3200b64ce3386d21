"""Sample records of each kind and their framed bytes with schema id 7."""

BUY_1 = dict(event="buy", sessionId="s1", timestamp="t", itemId=None, price=5, quantity=-1)
BUY_2 = dict(event="buy", sessionId="", timestamp="t", itemId="é", price=0, quantity=64)
CLICK_1 = dict(event="click", sessionId="s1", timestamp="t", category="S", itemId="i9")
TOPUP_1 = dict(
    createdAt="c", updatedAt="u", id="1", code="K", description="d", phoneNumber="09", partnerTransId="p",
    supplierTransId=None, jobId="j", isPostpaid=0, totalAmount=10000, discountRate=3, beforeCredit=50000,
    afterCredit=40000, ip="1.1.1.1", type=1, status=2, supplier="v", mobileData="m", merchantUser="u",
    merchantSubscription="s",
)
GOLDEN = [
    ("buy", BUY_1, "00 00000007 02 06 627579 02 04 7331 02 02 74 00 0a 01"),
    ("buy", BUY_2, "00 00000007 02 06 627579 02 00 02 02 74 02 04 c3a9 00 8001"),
    ("click", CLICK_1, "00 00000007 02 0a 636c69636b 02 04 7331 02 02 74 02 02 53 02 04 6939"),
    (
        "topup",
        TOPUP_1,
        "00 00000007 0263 0275 0231 024b 0264 043039 0270 00 02026a 00 a09c01 06 a08d06 80f104 "
        "0e312e312e312e31 02 04 0276 026d 0275 0273",
    ),
]
INT_BYTES = [
    (0, "00"), (-1, "01"), (1, "02"), (63, "7e"), (64, "8001"), (-64, "7f"), (-65, "8101"), (8191, "fe7f"),
    (8192, "808001"), (2147483647, "feffffff0f"), (-2147483648, "ffffffff0f"),
]


def frame(text: str) -> bytes:
    return bytes.fromhex(text.replace(" ", ""))
