"""Source registry and event-signature catalog.

Fixed values: contract addresses, first blocks and topic hashes are public
on-chain constants and must match for the decode to be right.
"""

from __future__ import annotations

from dataclasses import dataclass

POOL_MANAGER = "POOL_MANAGER"
POSITION_MANAGER = "POSITION_MANAGER"
HOOK_FACTORY = "HOOK_FACTORY"


@dataclass(frozen=True)
class Source:
    name: str
    address: str
    start_block: int


# Fixed values.
REGISTRY = (
    Source(POOL_MANAGER, "498581ff718922c3f8e6a244956af099b2652b2b", 25_350_988),
    Source(POSITION_MANAGER, "7c5f5a4bbd8fd63184577525326123b519429bdc", 25_350_993),
    Source(HOOK_FACTORY, "ef129a430032c8183aba158c1a70799e3b840df9", 28_450_225),
)

FIRST_BLOCK = 25_350_988
SEED_BLOCK = 26_990_278


@dataclass(frozen=True)
class Signature:
    kind: str
    source: str
    topic0: str
    topics: int
    data_bytes: int


# Fixed values.
SIGNATURES = (
    Signature(
        "Initialize",
        POOL_MANAGER,
        "dd466e674ea557f56295e2d0218a125ea4b4f0f6f3307b95f85e6110838d6438",
        4,
        160,
    ),
    Signature(
        "ModifyLiquidity",
        POOL_MANAGER,
        "f208f4912782fd25c7f114ca3723a2d5dd6f3bcc3ac8db5af63baa85f711d5ec",
        3,
        128,
    ),
    Signature(
        "Swap",
        POOL_MANAGER,
        "40e9cecb9f5f1f1c5b9c97dec2917b7ee92e57ba5563708daca94dd84ad7112f",
        3,
        192,
    ),
    Signature(
        "Subscription",
        POSITION_MANAGER,
        "9709492381f90bdc5938bb4e3b8e35b7e0eac8af058619e27191c5a40ce79fa9",
        3,
        0,
    ),
    Signature(
        "Unsubscription",
        POSITION_MANAGER,
        "a0ebb1de82db929a9153472f37d3a66dbede4436258311ad0f52a35a2c91d150",
        3,
        0,
    ),
    Signature(
        "Transfer",
        POSITION_MANAGER,
        "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef",
        4,
        0,
    ),
    Signature(
        "LogCreatePrivateHook",
        HOOK_FACTORY,
        "867a611de7aaecc0e286d0f3dcbf27249ad32a6b642b3d9311cf105c789d210c",
        3,
        32,
    ),
)

KINDS = tuple(s.kind for s in SIGNATURES)
POOL_KINDS = ("Initialize", "ModifyLiquidity", "Swap")
PRICE_KINDS = ("Initialize", "Swap")
CHANGE_KINDS = ("ModifyLiquidity", "Swap")
