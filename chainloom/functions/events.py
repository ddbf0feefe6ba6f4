"""Parameters of the event types, and reading them from topics and data words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainloom.functions.binding import bind
from chainloom.functions.hexes import hex_text, word_to_bigint, word_to_decimal
from chainloom.functions.keccak import keccak256

WORD_BYTES = 32

# Event types and their parameters (fixed values); an asterisk marks a parameter kept in the topics.
EVENT_TYPES = {
    "BaseInitialized": "name string, symbol string, timestamp uint256",
    "CollectModuleWhitelisted": "*collectModule address, *whitelisted bool, timestamp uint256",
    "CollectNFTDeployed": "*profileId uint256, *pubId uint256, *collectNFT address, timestamp uint256",
    "CollectNFTInitialized": "*profileId uint256, *pubId uint256, timestamp uint256",
    "CollectNFTTransferred": "*profileId uint256, *pubId uint256, *collectNFTId uint256, from address, to address, timestamp uint256",
    "Collected": "*collector address, *profileId uint256, *pubId uint256, rootProfileId uint256, rootPubId uint256, collectModuleData bytes, timestamp uint256",
    "CommentCreated": "*profileId uint256, *pubId uint256, contentURI string, profileIdPointed uint256, pubIdPointed uint256, referenceModuleData bytes, collectModule address, collectModuleReturnData bytes, referenceModule address, referenceModuleReturnData bytes, timestamp uint256",
    "DefaultProfileSet": "*wallet address, *profileId uint256, timestamp uint256",
    "DispatcherSet": "*profileId uint256, *dispatcher address, timestamp uint256",
    "EmergencyAdminSet": "*caller address, *oldEmergencyAdmin address, *newEmergencyAdmin address, timestamp uint256",
    "FeeModuleBaseConstructed": "*moduleGlobals address, timestamp uint256",
    "FollowModuleSet": "*profileId uint256, followModule address, followModuleReturnData bytes, timestamp uint256",
    "FollowModuleWhitelisted": "*followModule address, *whitelisted bool, timestamp uint256",
    "FollowNFTDelegatedPowerChanged": "*delegate address, *newPower uint256, timestamp uint256",
    "FollowNFTDeployed": "*profileId uint256, *followNFT address, timestamp uint256",
    "FollowNFTInitialized": "*profileId uint256, timestamp uint256",
    "FollowNFTTransferred": "*profileId uint256, *followNFTId uint256, from address, to address, timestamp uint256",
    "FollowNFTURISet": "*profileId uint256, followNFTURI string, timestamp uint256",
    "Followed": "*follower address, profileIds uint256[], followModuleDatas bytes[], timestamp uint256",
    "FollowsApproved": "*owner address, *profileId uint256, addresses address[], approved bool[], timestamp uint256",
    "FollowsToggled": "*owner address, profileIds uint256[], enabled bool[], timestamp uint256",
    "GovernanceSet": "*caller address, *prevGovernance address, *newGovernance address, timestamp uint256",
    "MirrorCreated": "*profileId uint256, *pubId uint256, profileIdPointed uint256, pubIdPointed uint256, referenceModuleData bytes, referenceModule address, referenceModuleReturnData bytes, timestamp uint256",
    "ModuleBaseConstructed": "*hub address, timestamp uint256",
    "ModuleGlobalsCurrencyWhitelisted": "*currency address, *prevWhitelisted bool, *whitelisted bool, timestamp uint256",
    "ModuleGlobalsGovernanceSet": "*prevGovernance address, *newGovernance address, timestamp uint256",
    "ModuleGlobalsTreasuryFeeSet": "*prevTreasuryFee uint16, *newTreasuryFee uint16, timestamp uint256",
    "ModuleGlobalsTreasurySet": "*prevTreasury address, *newTreasury address, timestamp uint256",
    "PostCreated": "*profileId uint256, *pubId uint256, contentURI string, collectModule address, collectModuleReturnData bytes, referenceModule address, referenceModuleReturnData bytes, timestamp uint256",
    "ProfileCreated": "*profileId uint256, *creator address, *to address, handle string, imageURI string, followModule address, followModuleReturnData bytes, followNFTURI string, timestamp uint256",
    "ProfileCreatorWhitelisted": "*profileCreator address, *whitelisted bool, timestamp uint256",
    "ProfileImageURISet": "*profileId uint256, imageURI string, timestamp uint256",
    "ProfileMetadataSet": "*profileId uint256, metadata string, timestamp uint256",
    "ReferenceModuleWhitelisted": "*referenceModule address, *whitelisted bool, timestamp uint256",
    "StateSet": "*caller address, *prevState uint8, *newState uint8, timestamp uint256",
}


@dataclass(frozen=True)
class Parameter:
    name: str
    type: str
    indexed: bool

    @property
    def dynamic(self) -> bool:
        return self.type in ("string", "bytes") or self.type.endswith("[]")


def parameters(event: str) -> list[Parameter]:
    out = []
    for part in EVENT_TYPES[event].split(", "):
        name, kind = part.split(" ")
        out.append(Parameter(name.lstrip("*"), kind, name.startswith("*")))
    return out


def signature(event: str) -> str:
    """The text that names an event type: its name and the types of its parameters."""
    return f"{event}({','.join(p.type for p in parameters(event))})"


@cache
def topic0(event: str) -> str:
    """The first topic of the logs of an event type, in hex."""
    return keccak256(signature(event).encode()).hex()


ZERO_BYTES = b"\x00" * WORD_BYTES


def _word(data: Column, at: Column | int) -> Column:
    """The 32 bytes that start at byte `at`; fewer past the end of the data."""
    start = F.lit(at + 1) if isinstance(at, int) else (at + 1).cast("int")
    return F.substring(data, start, F.lit(WORD_BYTES))


def _byte_count(data: Column, word: Column) -> Column:
    """The number in a word as a count of bytes, NULL when it points past the data."""
    small = F.substring(word, 1, WORD_BYTES - 4) == F.lit(ZERO_BYTES[:-4])
    number = F.conv(F.hex(F.substring(word, WORD_BYTES - 3, 4)), 16, 10).cast("bigint")
    return F.when(small & (number <= F.octet_length(data)), number)


def _static(word: Column, kind: str, numbers: str) -> Column:
    whole = F.octet_length(word) == WORD_BYTES
    if kind == "address":
        return F.when(whole, hex_text(F.substring(word, 13, 20)))
    if kind == "bool":
        return F.when(whole, word != F.lit(ZERO_BYTES))
    if kind in ("uint8", "uint16"):
        return word_to_bigint(hex_text(word)).try_cast("int")
    if numbers == "bigint":
        return word_to_bigint(hex_text(word))
    if numbers == "decimal":
        return word_to_decimal(hex_text(word))
    return F.when(whole, hex_text(word))


def _content(data: Column, at: Column, size: Column, kind: str) -> Column:
    """The length-prefixed bytes at byte `at`; NULL when they are cut off."""
    content = F.substring(data, (at + WORD_BYTES + 1).cast("int"), size.cast("int"))
    whole = F.when(F.octet_length(content) == size, content)
    if kind == "bytes":
        return hex_text(whole)
    # Bytes that are no UTF-8 do not decode to text.
    return F.try_validate_utf8(whole.cast("string"))


def _elements(data: Column, at: Column, count: Column, kind: str, numbers: str) -> Column:
    body = at + WORD_BYTES

    def element(index: Column) -> Column:
        word = _word(data, body + index * WORD_BYTES)
        if kind in ("string", "bytes"):
            start = body + _byte_count(data, word)
            return _content(data, start, _byte_count(data, _word(data, start)), kind)
        return _static(word, kind, numbers)

    inside = body + count * WORD_BYTES <= F.octet_length(data)
    indexes = F.filter(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: i < count)
    return F.when(inside, F.transform(indexes, element))


def read_parameters(
    logs: DataFrame, wanted: Sequence[Parameter], all_parameters: Sequence[Parameter], numbers: str
) -> DataFrame:
    """Add the wanted parameters as columns.

    Parameters of variable size are found in two steps, their place and then their size. Each step is
    bound, so that no expression contains another one whole.
    """
    data, topics = F.col("data"), F.col("topics")
    heads: dict[str, int] = {}
    topic_of: dict[str, int] = {}
    for p in all_parameters:
        if p.indexed:
            topic_of[p.name] = len(topic_of) + 1
        else:
            heads[p.name] = len(heads) * WORD_BYTES
    moving = [p for p in wanted if not p.indexed and p.dynamic]
    located = logs
    if moving:
        places = {f"__at_{p.name}": _byte_count(data, _word(data, heads[p.name])) for p in moving}
        located = bind(located, **places)
        sizes = {
            f"__size_{p.name}": _byte_count(data, _word(data, F.col(f"__at_{p.name}"))) for p in moving
        }
        located = bind(located, **sizes)
    columns = []
    for p in wanted:
        if p.indexed:
            # A topic holds only the hash of a parameter of variable size.
            topic = F.get(topics, F.lit(topic_of[p.name]))
            column = hex_text(topic) if p.dynamic else _static(topic, p.type, numbers)
        elif not p.dynamic:
            column = _static(_word(data, heads[p.name]), p.type, numbers)
        else:
            at, size = F.col(f"__at_{p.name}"), F.col(f"__size_{p.name}")
            if p.type.endswith("[]"):
                column = _elements(data, at, size, p.type[:-2], numbers)
            else:
                column = _content(data, at, size, p.type)
        columns.append(column.alias(p.name))
    return located.select(*logs.columns, *columns)
